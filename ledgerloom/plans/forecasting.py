"""Monthly sales: model frame, model suite, forecast, spend regression, lag tests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.calendar import log_floor
from ledgerloom.functions.nulls import nz, safe_pct, strip_thousands
from ledgerloom.functions.periods import parse_mm_yy
from ledgerloom.operators import regression as reg
from ledgerloom.operators import series as ser
from ledgerloom.operators.relational import merge_series

# Base features and the six nested models.
BASE = ["trend", "sin_12", "cos_12", "sin_6", "covid_dip", "yearend"]
MODEL_SUITE = {
    "A": BASE,
    "B": BASE + ["log_asp"],
    "C": BASE + ["log_asp", "log_mkt_old"],
    "D": BASE + ["log_asp", "log_mkt_new"],
    "E": BASE + ["log_asp", "gdp"],
    "F": BASE + ["log_asp", "tet_feb"],
}
FORECAST_FEATURES = ["trend", "sin_12", "cos_12", "sin_6", "sale_lag1", "roll_ma3", "covid_dip", "yearend"]
MIN_ROWS = 20


def model_frame(
    sales: DataFrame,
    others: Sequence[DataFrame],
    logs: Mapping[str, tuple[str, float]],
    lags: Mapping[str, Sequence[int]] | None = None,
    keys: Sequence[str] = (),
    **calendar,
) -> DataFrame:
    """Monthly frame: left merge on month, trend, calendar features, floored logs, lags.

    `logs` maps a new column to (source, floor); `lags` maps a column to its lag steps (columns `<name>_l<n>`).
    """
    out = merge_series([sales, *others], ser.MONTH)
    out = ser.with_calendar(ser.with_trend(out, keys), **calendar)
    out = out.withColumns({name: log_floor(F.col(src), floor) for name, (src, floor) in logs.items()})
    for name, steps in (lags or {}).items():
        out = ser.with_lags(out, name, steps, f"{name}_l", keys)
    return out


def model_suite(train: DataFrame, target: str = "log_qty", specs: Mapping[str, Sequence[str]] = MODEL_SUITE) -> DataFrame:
    """Comparison table of the nested models: r2, adj r2, MAPE in original units, F, price and spend coefficients."""
    fit = reg.fit_ols(train, target, specs)
    features = list(dict.fromkeys(f for names in specs.values() for f in names))
    scored = reg.score_ols(train, fit, features)
    quality = reg.accuracy(scored, F.exp(F.col(target)), F.exp(F.col("predicted")), ["spec"]).select("spec", "mape")
    table = fit.select(
        "spec",
        "n",
        F.col("k").alias("n_features"),
        "r2",
        "adj_r2",
        "f_stat",
        "p_f",
        reg.coefficient("log_asp").alias("asp_coef"),
        F.coalesce(reg.coefficient("log_mkt_old"), reg.coefficient("log_mkt_new")).alias("mkt_coef"),
    )
    return table.join(quality, "spec")


def grouped_models(train: DataFrame, group: str, target: str, price: str = "log_asp") -> DataFrame:
    """Models B and F per group or channel, with the price elasticity and its 5 % and 10 % effects."""
    specs = {"B": BASE + [price], "F": BASE + [price, "tet_feb"]}
    features = BASE + [price, "tet_feb"]
    fit = reg.fit_ols(train, target, specs, [group])
    scored = reg.score_ols(train, fit, features, [group])
    quality = reg.accuracy(scored, F.exp(F.col(target)), F.exp(F.col("predicted")), [group, "spec"]).select(
        group, "spec", "mape"
    )
    coef = reg.coefficient(price)
    table = fit.select(
        group,
        "spec",
        "n",
        "r2",
        "adj_r2",
        coef.alias("asp_coef"),
        reg.elasticity_effect(coef, 0.05).alias("effect_5"),
        reg.elasticity_effect(coef, 0.10).alias("effect_10"),
    )
    return table.join(quality, [group, "spec"])


def error_table(scored: DataFrame, actual: str = "total_sale", predicted: str = "predicted") -> DataFrame:
    """Month, actual, predicted, error and percentage errors."""
    error = F.col(actual) - F.col(predicted)
    return scored.select(
        ser.MONTH,
        F.col(actual).alias("actual"),
        F.col(predicted).alias("predicted"),
        error.alias("error"),
        safe_pct(error, F.col(actual)).alias("error_pct"),
        F.abs(safe_pct(error, F.col(actual))).alias("abs_error_pct"),
    )


def baseline_gain(frame: DataFrame, scored: DataFrame, train_end: str, actual: str = "total_sale") -> DataFrame:
    """MAPE of the model and of the 12-month naive mean on the months after the split, and the gain in points."""
    naive = frame.withColumn("_naive", ser.trailing12(actual)).filter(F.col(ser.MONTH) > train_end)
    rows = naive.select(ser.MONTH, actual, "_naive").join(scored.select(ser.MONTH, "predicted"), ser.MONTH)
    pct = lambda c: F.avg(F.abs(safe_pct(F.col(actual) - F.col(c), F.col(actual))))
    return rows.agg(pct("predicted").alias("model_mape"), pct("_naive").alias("naive_mape")).withColumn(
        "gain_pp", F.col("naive_mape") - F.col("model_mape")
    )


def forecast_frame(monthly: DataFrame, include_current: bool = False, **calendar) -> DataFrame:
    """Features of the volume forecast: trend, seasonality, previous month and mean of three months."""
    out = ser.with_calendar(ser.with_trend(monthly), **calendar)
    out = out.withColumn("sale_lag1", F.lag("total_sale", 1).over(ser.by_month()))
    return out.withColumn("roll_ma3", ser.rolling3("total_sale", include_current))


def volume_forecast(monthly: DataFrame, train_end: str, include_current: bool = False, **calendar):
    """(fit, in-sample accuracy, one-step-ahead validation table).

    The lag and mean of a validation month come from the actual months before it, and the trend runs on, so the
    validation rows are scored in one pass like the training rows.
    """
    frame = forecast_frame(monthly, include_current, **calendar).dropna(subset=FORECAST_FEATURES)
    train, rest = ser.split_by_month(frame, train_end)
    fit = reg.fit_ols(train, "total_sale", {"volume": FORECAST_FEATURES})
    inside = reg.accuracy(reg.score_ols(train, fit, FORECAST_FEATURES), F.col("total_sale"), F.col("predicted"))
    return fit, inside, error_table(reg.score_ols(rest, fit, FORECAST_FEATURES))


def screen_regressors(frame: DataFrame, regressors: Sequence[str], targets: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """Simple regression of every target on every regressor, with MAE and verdict.

    MAE needs the fitted line, so a second aggregate runs over the rows with all lines in a scalar subquery
    (joined by group where there are groups).
    """
    fits = reg.simple_ols(frame, [(x, y) for y in targets for x in regressors], groups)
    lines = fits.select(*groups, F.struct("x", "y", "slope", "intercept").alias("_l"))
    if groups:
        rows = frame.join(lines, list(groups))
    else:
        rows = frame.withColumn("_l", F.explode(lines.select(F.collect_list("_l")).scalar()))
    pick = lambda names, field: F.coalesce(*[F.when(F.col(f"_l.{field}") == n, F.col(n).cast("double")) for n in names])
    miss = F.abs(pick(targets, "y") - F.col("_l.intercept") - F.col("_l.slope") * pick(regressors, "x"))
    maes = rows.groupBy(*groups, F.col("_l.x").alias("x"), F.col("_l.y").alias("y")).agg(F.avg(miss).alias("mae"))
    significant, verdict = reg.screening_verdict(F.col("r2"), F.col("p"))
    return fits.join(maes, [*groups, "x", "y"]).withColumn("significant", significant).withColumn("verdict", verdict)


def spend_by_month(ledger: DataFrame) -> DataFrame:
    """Ledger text lines to monthly spend: separators stripped, unreadable amounts 0, positive amounts only."""
    rows = ledger.select(
        parse_mm_yy(F.col("period")).alias(ser.MONTH), nz(strip_thousands(F.col("value"), "decimal(18,2)")).alias("value")
    )
    kept = rows.filter((F.col("value") > 0) & F.col(ser.MONTH).isNotNull())
    return kept.groupBy(ser.MONTH).agg(F.sum("value").cast("double").alias("marketing_spend"))


def lag_tests(frame: DataFrame, target: str, base: Sequence[str], spend: str, lags: Sequence[int] = (0, 1, 2, 3)) -> DataFrame:
    """Base model against base + lagged spend, per lag: r2 of both, gain, coefficient, p, significance.

    The lags are stacked so that every lag keeps its own complete rows and one grouped aggregate fits all models.
    """
    column = lambda n: spend if n == 0 else f"{spend}_l{n}"
    stacked = frame.select(
        target, *base, F.inline(F.array(*[F.struct(F.lit(n).alias("lag"), F.col(column(n)).alias("lagged")) for n in lags]))
    )
    both_known = stacked.dropna(subset=["lagged"])  # the base model of a lag uses the rows of the lagged one
    fit = reg.fit_ols(both_known, target, {"base": list(base), "lagged": [*base, "lagged"]}, ["lag"])
    both = fit.groupBy("lag").agg(
        F.max("n").alias("n"),
        F.max(F.when(F.col("spec") == "base", F.col("r2"))).alias("r2_base"),
        F.max(F.when(F.col("spec") == "lagged", F.col("r2"))).alias("r2_with_lag"),
        F.max(F.when(F.col("spec") == "lagged", reg.coefficient("lagged"))).alias("lag_coef"),
        F.max(F.when(F.col("spec") == "lagged", reg.coefficient_p("lagged"))).alias("p_lag"),
    )
    return both.withColumn("delta_r2", F.col("r2_with_lag") - F.col("r2_base")).withColumn(
        "significant", F.col("p_lag") < reg.ALPHA
    )


def lag_grid(frame: DataFrame, group: str, target: str, spend: str, lags: Sequence[int] = (0, 1, 2, 3), min_rows: int = MIN_ROWS) -> DataFrame:
    """r2 and p of target ~ lagged spend per group and lag; NULL below `min_rows` rows."""
    column = lambda n: spend if n == 0 else f"{spend}_l{n}"
    fits = reg.simple_ols(frame, [(column(n), target) for n in lags], [group])
    lag = F.when(F.col("x") == spend, 0).otherwise(F.regexp_extract("x", r"_l(\d+)$", 1).try_cast("int"))
    enough = F.col("n") >= min_rows
    return fits.select(group, lag.alias("lag"), "n", F.when(enough, F.col("r2")).alias("r2"), F.when(enough, F.col("p")).alias("p"))




def spend_regression(monthly: DataFrame, ledger: DataFrame) -> DataFrame:
    """Monthly sales on the monthly spend of a ledger."""
    joined = monthly.join(spend_by_month(ledger), ser.MONTH).dropna(subset=["total_sale", "marketing_spend"])
    return reg.simple_ols(joined, [("marketing_spend", "total_sale")])


def macro_screening(frame: DataFrame, regressors: Sequence[str], target: str = "total_sale") -> DataFrame:
    """One row per regressor and one for all of them together: r2, p, slope, F, MAE, significance, verdict."""
    rows = frame.dropna(subset=[target, *regressors])
    columns = ["x", "r2", "p", "slope", "f_stat", "mae", "significant", "verdict"]
    single = screen_regressors(rows, regressors, [target]).select(*columns)
    fit = reg.fit_ols(rows, target, {"all": list(regressors)})
    scored = reg.score_ols(rows, fit, regressors)
    mae = reg.accuracy(scored, F.col(target), F.col("predicted")).select("mae").scalar()
    significant, verdict = reg.combined_verdict(F.col("r2"), F.col("p_f"))
    combined = fit.select(
        F.col("spec").alias("x"),
        "r2",
        F.col("p_f").alias("p"),
        F.lit(None).cast("double").alias("slope"),
        "f_stat",
        mae.alias("mae"),
        significant.alias("significant"),
        verdict.alias("verdict"),
    )
    return single.unionByName(combined)
