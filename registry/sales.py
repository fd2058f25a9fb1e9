"""Sales-series and regression queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import calendar
from ledgerloom.operators import regression as reg
from ledgerloom.operators import series as ser
from ledgerloom.operators.relational import merge_series
from ledgerloom.plans import forecasting as fc
from ledgerloom.session import cut_lineage
from ledgerloom.sources.sinks import write_delimited
from ledgerloom.sources.tables import csv_table
from registry.analogues import Tables
from registry.common import query, r, scratch
from registry.model_sql import f_tail, ols, t_tail

TRAIN_END = "2000-12"
DIP = {"dip_year": 1998}
LOGS = {
    "log_qty": ("total_sale", 0.001), "log_asp": ("asp", 1.0), "log_mkt_old": ("mkt_old", 0.1), "log_mkt_new": ("mkt_new", 0.1),
}
MACROS = ["cpi", "rate", "gdp"]

CALENDAR_SQL = """sin(2 * pi() * mn / 12) AS sin_12, cos(2 * pi() * mn / 12) AS cos_12, sin(2 * pi() * mn / 6) AS sin_6,
  CASE WHEN left(year_month, 4) = '1998' AND mn IN (7, 8, 9) THEN 1 ELSE 0 END AS covid_dip, CASE WHEN mn IN (11, 12) THEN 1 ELSE 0 END AS yearend, CASE WHEN mn = 2 THEN 1 ELSE 0 END AS tet_feb"""

FRAME = {
    "frame0": "SELECT s.*, cpi, rate, gdp, asp, mkt_old, mkt_new, CAST(right(s.year_month, 2) AS INT) AS mn, row_number() OVER (ORDER BY s.year_month) AS trend FROM monthly_sales s LEFT JOIN macro USING (year_month)",
    "frame": f"""SELECT *, {CALENDAR_SQL}, ln(total_sale) AS log_qty, ln(greatest(asp, 1.0)) AS log_asp, ln(greatest(mkt_old, 0.1)) AS log_mkt_old, ln(greatest(mkt_new, 0.1)) AS log_mkt_new FROM frame0""",
    "lagged": "SELECT *, lag(log_mkt_new, 1) OVER w AS log_mkt_new_l1, lag(log_mkt_new, 2) OVER w AS log_mkt_new_l2, lag(log_mkt_new, 3) OVER w AS log_mkt_new_l3 FROM frame WINDOW w AS (ORDER BY year_month)",
    "train": f"SELECT * FROM lagged WHERE year_month <= '{TRAIN_END}'",
}
CHANNEL = {
    "channel0": "SELECT s.year_month, channel, qty, s.asp, mkt_old, mkt_new, cpi, rate, gdp, CAST(right(s.year_month, 2) AS INT) AS mn, row_number() OVER (PARTITION BY channel ORDER BY s.year_month) AS trend FROM channel_sales s LEFT JOIN macro USING (year_month)",
    "channel1": f"SELECT *, {CALENDAR_SQL}, ln(greatest(qty, 0.001)) AS log_qty, ln(greatest(asp, 1.0)) AS log_asp, ln(greatest(mkt_old, 0.1)) AS log_mkt_old, ln(greatest(mkt_new, 0.1)) AS log_mkt_new FROM channel0",
    "channel2": "SELECT *, lag(log_mkt_new, 1) OVER w AS log_mkt_new_l1, lag(log_mkt_new, 2) OVER w AS log_mkt_new_l2, lag(log_mkt_new, 3) OVER w AS log_mkt_new_l3 FROM channel1 WINDOW w AS (PARTITION BY channel ORDER BY year_month)",
    "channel_train": f"SELECT * FROM channel2 WHERE year_month <= '{TRAIN_END}'",
}


def frame(t: Tables):
    """Months with all features. The scan of the transactions ends here: the few monthly rows are checkpointed, and
    every fit and score after that reads them."""
    return cut_lineage(fc.model_frame(t.monthly_sales(), [t.macro()], LOGS, {"log_mkt_new": (1, 2, 3)}, **DIP))


def train(t: Tables):
    return ser.split_by_month(frame(t), TRAIN_END)[0]


def channel_train(t: Tables):
    macro = t.macro().drop("asp")
    logs = {**LOGS, "log_qty": ("qty", 0.001)}
    out = fc.model_frame(t.channel_sales(), [macro], logs, {"log_mkt_new": (1, 2, 3)}, ["channel"], **DIP)
    return ser.split_by_month(cut_lineage(out), TRAIN_END)[0]


# --- sink, filter, join, aggregate ------------------------------------------------------------------------------


@query("snk01_delimited_sink", f"SELECT year_month, {r('total_sale', 'total_sale', 2)} FROM monthly_sales", digits=2)
def _(t: Tables):
    path = scratch(t.spark)
    write_delimited(t.monthly_sales(), path)
    return csv_table(t.spark, path, "year_month string, total_sale double")


@query("flt11_month_split", f"SELECT 'train' AS part, count(*) AS n, max(year_month) AS last FROM monthly_sales WHERE year_month <= '{TRAIN_END}' UNION ALL SELECT 'validation', count(*), max(year_month) FROM monthly_sales WHERE year_month > '{TRAIN_END}'")
def _(t: Tables):
    first, second = ser.split_by_month(t.monthly_sales(), TRAIN_END)
    side = lambda df, name: df.agg(F.lit(name).alias("part"), F.count("*").alias("n"), F.max("year_month").alias("last"))
    return side(first, "train").unionByName(side(second, "validation"))


@query("jn13_merge_monthly_series", f"SELECT s.year_month, {r('total_sale', 'total_sale')}, {r('cpi', 'cpi')}, {r('q', 'urgent')}, {r('o', 'other')} FROM monthly_sales s LEFT JOIN macro USING (year_month) LEFT JOIN (SELECT year_month, sum(qty) FILTER (grp = '1-URGENT') AS q, sum(qty) FILTER (grp <> '1-URGENT') AS o FROM group_sales GROUP BY 1) USING (year_month)")
def _(t: Tables):
    urgent = t.group_sales().filter("grp = '1-URGENT'").select("year_month", F.col("qty").alias("urgent"))
    other = t.group_sales().filter("grp <> '1-URGENT'").groupBy("year_month").agg(F.sum("qty").alias("other"))
    merged = merge_series([t.monthly_sales(), t.macro(), urgent, other], "year_month")
    return merged.select("year_month", "total_sale", "cpi", "urgent", "other")


@query("ag09_monthly_totals", f"SELECT year_month, {r('total_sale', 'total_sale')} FROM monthly_sales")
def _(t: Tables):
    return ser.monthly_totals(t.sales_txn(), "trx_date", "sale", "total_sale")


# --- windows ----------------------------------------------------------------------------------------------------


@query("wn02_lags", f"SELECT year_month, {r('lag(total_sale, 1) OVER w', 'sale_lag1')}, {r('lag(total_sale, 2) OVER w', 'sale_lag2')}, {r('lag(total_sale, 3) OVER w', 'sale_lag3')} FROM monthly_sales WINDOW w AS (ORDER BY year_month)")
def _(t: Tables):
    return ser.with_lags(t.monthly_sales(), "total_sale", (1, 2, 3), "sale_lag").drop("total_sale")


@query("wn03_moving_mean_3", f"SELECT year_month, {r('CASE WHEN row_number() OVER w >= 3 THEN avg(total_sale) OVER (ORDER BY year_month ROWS 2 PRECEDING) END', 'roll_ma3')} FROM monthly_sales WINDOW w AS (ORDER BY year_month)")
def _(t: Tables):
    return t.monthly_sales().select("year_month", ser.rolling3("total_sale", include_current=True).alias("roll_ma3"))


@query("wn04_trailing_mean_12", f"SELECT year_month, {r('avg(total_sale) OVER (ORDER BY year_month ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)', 'naive')} FROM monthly_sales")
def _(t: Tables):
    return t.monthly_sales().select("year_month", ser.trailing12("total_sale").alias("naive"))


@query("wn05_one_step_predictors", f"SELECT year_month, {r('lag(total_sale) OVER w', 'sale_lag1')}, {r('CASE WHEN row_number() OVER w > 3 THEN avg(total_sale) OVER (ORDER BY year_month ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) END', 'roll_ma3')} FROM monthly_sales WINDOW w AS (ORDER BY year_month)")
def _(t: Tables):
    return fc.forecast_frame(t.monthly_sales()).select("year_month", "sale_lag1", "roll_ma3")


@query("wn06_trend_index", "SELECT channel, year_month, row_number() OVER (PARTITION BY channel ORDER BY year_month) AS trend FROM channel_sales")
def _(t: Tables):
    return ser.with_trend(t.channel_sales(), ["channel"]).select("channel", "year_month", "trend")


@query("wn10_z_score", f"SELECT channel, year_month, {r('(qty - avg(qty) OVER w) / stddev_pop(qty) OVER w', 'qty_z')}, {r('(asp - avg(asp) OVER w) / stddev_pop(asp) OVER w', 'asp_z')} FROM channel_sales WINDOW w AS (PARTITION BY channel)")
def _(t: Tables):
    return ser.standardise(t.channel_sales(), ["qty", "asp"], "_z", ["channel"]).select("channel", "year_month", "qty_z", "asp_z")


# --- scalars ----------------------------------------------------------------------------------------------------


@query("sc11_seasonal_harmonics", f"SELECT o_orderkey, {r('sin(2 * pi() * month(o_orderdate) / 12)', 'sin_12')}, {r('cos(2 * pi() * month(o_orderdate) / 12)', 'cos_12')}, {r('sin(2 * pi() * month(o_orderdate) / 6)', 'sin_6')} FROM orders")
def _(t: Tables):
    return t("orders").select("o_orderkey", *[c.alias(n) for n, c in calendar.calendar_columns(F.col("o_orderdate")).items() if n in ("sin_12", "cos_12", "sin_6")])


@query("sc12_calendar_flags", "SELECT o_orderkey, CAST(year(o_orderdate) = 1998 AND month(o_orderdate) IN (7, 8, 9) AS BIGINT) AS covid_dip, CAST(month(o_orderdate) IN (11, 12) AS BIGINT) AS yearend, CAST(month(o_orderdate) = 2 AS BIGINT) AS tet_feb FROM orders")
def _(t: Tables):
    return t("orders").select("o_orderkey", *[c.alias(n) for n, c in calendar.calendar_columns(F.col("o_orderdate"), **DIP).items() if n in ("covid_dip", "yearend", "tet_feb")])


@query("sc13_logs_with_floor", f"SELECT c_custkey, {r('ln(greatest(c_acctbal, 0.1))', 'log_bal')}, {r('ln(1 + greatest(c_acctbal, 0))', 'log1p_bal')}, {r('exp(ln(greatest(c_acctbal, 1)))', 'back', 2)} FROM customer")
def _(t: Tables):
    b = F.col("c_acctbal")
    return t("customer").select(
        "c_custkey", calendar.log_floor(b, 0.1).alias("log_bal"), F.log1p(F.greatest(b, F.lit(0.0))).alias("log1p_bal"), F.round(F.exp(calendar.log_floor(b, 1.0)), 2).alias("back")
    )


@query("sc14_numeric_functions", f"SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, {r('pow(1.05, l_quantity / 10)', 'p')}, {r('abs(l_discount - l_tax)', 'a')}, {r('sqrt(l_extendedprice)', 's')}, round_even(CAST(l_quantity AS DOUBLE) / 4, 0) AS half_even FROM lineitem")
def _(t: Tables):
    q = F.col("l_quantity")
    return t("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.pow(F.lit(1.05), q / 10).alias("p"), F.abs(F.col("l_discount") - F.col("l_tax")).alias("a"), F.sqrt("l_extendedprice").alias("s"), F.bround(q / 4, 0).alias("half_even"),
    )


# --- regressions ------------------------------------------------------------------------------------------------


def simple_sql(rows: str, x: str, y: str, group: str = "") -> str:
    """n, slope, intercept, r2, se, t, p, CI by the closed forms; the t quantile comes from the p of the bound."""
    g = f"{group}, " if group else ""
    by = f"GROUP BY {group}" if group else ""
    return f"""SELECT {g}'{x}' AS x, '{y}' AS y, CAST(regr_count({y}, {x}) AS BIGINT) AS n, regr_slope({y}, {x}) AS slope, regr_intercept({y}, {x}) AS intercept, regr_r2({y}, {x}) AS r2,
  sqrt((1 - regr_r2({y}, {x})) * regr_syy({y}, {x}) / (regr_count({y}, {x}) - 2) / regr_sxx({y}, {x})) AS se FROM {rows} {by}"""


P = t_tail("slope / se", "n - 2")


@query(
    "ml01_simple_ols",
    f"SELECT x, y, n, {r('slope', 'slope', 2)}, {r('intercept', 'intercept', 2)}, {r('r2', 'r2')}, {r('se', 'se', 2)}, {r('slope / se', 't')}, {r(P, 'p')}, {r('r2 / (1 - r2) * (n - 2)', 'f_stat')} FROM simple",
    {**FRAME, "simple": " UNION ALL ".join(simple_sql("train", x, "total_sale") for x in MACROS)},
)
def _(t: Tables):
    out = reg.simple_ols(train(t), [(x, "total_sale") for x in MACROS]).drop("ci_lo", "ci_hi")
    return out.withColumns({c: F.round(c, 2) for c in ("slope", "intercept", "se")})


@query(
    "ml01_confidence_interval",
    f"SELECT x, {r('2 * slope', 'ci_sum', 2)}, {r(t_tail('(ci_hi - slope) / se', 'n - 2'), 'tail_of_bound')} FROM (SELECT *, slope + se * quantile AS ci_hi FROM simple, tq)",
    {
        **FRAME,
        "simple": " UNION ALL ".join(simple_sql("train", x, "total_sale") for x in MACROS),
        "tq": f"SELECT min(q) AS quantile FROM (SELECT 1.98 + i / 50000.0 AS q FROM range(0, 1500) AS s(i)) WHERE {t_tail('q', '70')} <= 0.05",
    },
)
def _(t: Tables):
    from ledgerloom.functions.stats import t_pvalue

    out = reg.simple_ols(train(t), [(x, "total_sale") for x in MACROS])
    bound = t_pvalue(F.try_divide(F.col("ci_hi") - F.col("slope"), F.col("se")), (F.col("n") - 2).cast("double"))
    return out.select("x", F.round(F.col("ci_lo") + F.col("ci_hi"), 2).alias("ci_sum"), bound.alias("tail_of_bound"))


def coef_rows(name: str, features: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT g, '{f}' AS feature, b[{i + 1}] AS coef FROM {name}" for i, f in enumerate(features))


@query(
    "ml02_multiple_ols",
    f"SELECT n, CAST(k AS BIGINT) AS k, {r('r2', 'r2')}, {r('adj_r2', 'adj_r2')}, {r('f_stat', 'f_stat')}, {r(f_tail('f_stat', '3', 'n - 4'), 'p_f')}, {r('intercept', 'intercept', 1)}, {r('b[1]', 'cpi', 1)}, {r('b[2]', 'rate', 1)}, {r('b[3]', 'gdp', 1)}, {r('mae', 'mae', 1)} FROM fit, (SELECT avg(abs(total_sale - intercept - b[1] * cpi - b[2] * rate - b[3] * gdp)) AS mae FROM train, fit)",
    {**FRAME, **ols("fit", "train", "total_sale", MACROS)},
)
def _(t: Tables):
    rows = train(t)
    fit = reg.fit_ols(rows, "total_sale", {"all": MACROS})
    mae = reg.accuracy(reg.score_ols(rows, fit, MACROS), F.col("total_sale"), F.col("predicted")).select("mae").scalar()
    out = fit.select("n", "k", "r2", "adj_r2", "f_stat", "p_f", "intercept", *[reg.coefficient(m).alias(m) for m in MACROS], mae.alias("mae"))
    return out.withColumns({c: F.round(c, 1) for c in ("intercept", *MACROS, "mae")})


def mape_sql(rows: str, fit: str, y: str, features: list[str], on: str = "true") -> str:
    pred = "intercept + " + " + ".join(f"b[{i + 1}] * {f}" for i, f in enumerate(features))
    return f"SELECT g, avg(abs(exp({y}) - exp({pred})) / exp({y})) * 100 AS mape FROM {rows} JOIN {fit} ON {on} GROUP BY g"


SUITE = {}
for _name, _features in fc.MODEL_SUITE.items():
    SUITE.update(ols(f"fit{_name}", "train", "log_qty", _features, group=f"'{_name}'"))
    SUITE[f"mape{_name}"] = mape_sql("train", f"fit{_name}", "log_qty", _features)


def suite_row(name: str) -> str:
    features = fc.MODEL_SUITE[name]
    at = lambda f: f"b[{features.index(f) + 1}]" if f in features else "CAST(NULL AS DOUBLE)"
    mkt = at("log_mkt_old") if "log_mkt_old" in features else at("log_mkt_new")
    return f"SELECT f.g AS spec, n, k AS n_features, r2, adj_r2, f_stat, {f_tail('f_stat', 'k', 'n - k - 1')} AS p_f, {at('log_asp')} AS asp_coef, {mkt} AS mkt_coef, mape FROM fit{name} f JOIN mape{name} m ON m.g = f.g"


@query(
    "ml03_model_suite",
    f"SELECT spec, n, CAST(n_features AS BIGINT) AS n_features, {r('r2', 'r2')}, {r('adj_r2', 'adj_r2')}, {r('f_stat', 'f_stat', 3)}, {r('p_f', 'p_f')}, {r('asp_coef', 'asp_coef')}, {r('mkt_coef', 'mkt_coef')}, {r('mape', 'mape')} FROM suite",
    {**FRAME, **SUITE, "suite": " UNION ALL ".join(suite_row(n) for n in fc.MODEL_SUITE)},
)
def _(t: Tables):
    return fc.model_suite(train(t)).withColumn("f_stat", F.round("f_stat", 3))


def grouped_sql(rows: str, group: str) -> dict[str, str]:
    out = {}
    for spec in ("B", "F"):
        features = fc.MODEL_SUITE[spec]
        out.update(ols(f"gfit{spec}", rows, "log_qty", features, group))
        out[f"gmape{spec}"] = mape_sql(rows, f"gfit{spec}", "log_qty", features, f"{group} = g")
        asp = features.index("log_asp") + 1
        out[f"grow{spec}"] = f"""SELECT f.g, '{spec}' AS spec, n, r2, adj_r2, b[{asp}] AS asp_coef, (pow(1.05, b[{asp}]) - 1) * 100 AS effect_5, (pow(1.10, b[{asp}]) - 1) * 100 AS effect_10, mape
  FROM gfit{spec} f JOIN gmape{spec} m ON m.g = f.g"""
    out["grows"] = "SELECT * FROM growB UNION ALL SELECT * FROM growF"
    return out


GROUPED_COLS = f"spec, n, {r('r2', 'r2')}, {r('adj_r2', 'adj_r2')}, {r('asp_coef', 'asp_coef')}, {r('effect_5', 'effect_5')}, {r('effect_10', 'effect_10')}, {r('mape', 'mape')}"


@query("ml04_grouped_models", f"SELECT g AS channel, {GROUPED_COLS} FROM grows", {**CHANNEL, **grouped_sql("channel_train", "channel")})
def _(t: Tables):
    return fc.grouped_models(channel_train(t), "channel", "log_qty")


@query(
    "ml04_channel_coefficients",
    f"SELECT g AS channel, feature, {r('coef', 'coef')} FROM ({coef_rows('gfitF', fc.MODEL_SUITE['F'])} UNION ALL SELECT g, 'intercept', intercept FROM gfitF)",
    {**CHANNEL, **grouped_sql("channel_train", "channel")},
)
def _(t: Tables):
    fit = reg.fit_ols(channel_train(t), "log_qty", {"F": fc.MODEL_SUITE["F"]}, ["channel"])
    return reg.coefficients(fit, ["channel"]).select("channel", "feature", "coef")


@query("ml05_price_elasticity", f"SELECT g AS channel, {r('asp_coef', 'asp_coef')}, {r('effect_5', 'effect_5')}, {r('effect_10', 'effect_10')} FROM growB", {**CHANNEL, **grouped_sql("channel_train", "channel")})
def _(t: Tables):
    return fc.grouped_models(channel_train(t), "channel", "log_qty").filter("spec = 'B'").select("channel", "asp_coef", "effect_5", "effect_10")


@query(
    "ml06_forecast_accuracy",
    f"SELECT channel, count(*) AS n, {r('1 - sum(pow(qty - prev, 2)) / (count(*) * var_pop(qty))', 'r2')}, {r('avg(abs(qty - prev))', 'mae', 2)}, {r('avg(abs(qty - prev) / qty) * 100', 'mape')}, {r('avg(qty - prev)', 'mean_error', 2)} FROM (SELECT *, lag(qty) OVER (PARTITION BY channel ORDER BY year_month) AS prev FROM channel_sales) WHERE prev IS NOT NULL GROUP BY 1",
)
def _(t: Tables):
    rows = ser.with_lags(t.channel_sales(), "qty", (1,), "prev", ["channel"])
    out = reg.accuracy(rows, F.col("qty"), F.col("prev1"), ["channel"])
    return out.withColumns({c: F.round(c, 2) for c in ("mae", "mean_error")})


LAG_BASE = fc.MODEL_SUITE["F"]
LAG_SQL = {}
for _n in range(4):
    _col = "log_mkt_new" if _n == 0 else f"log_mkt_new_l{_n}"
    LAG_SQL[f"lag_rows{_n}"] = f"SELECT * FROM train WHERE {_col} IS NOT NULL"
    LAG_SQL.update(ols(f"lbase{_n}", f"lag_rows{_n}", "log_qty", LAG_BASE))
    LAG_SQL.update(ols(f"lfull{_n}", f"lag_rows{_n}", "log_qty", [*LAG_BASE, _col]))
LAG_SQL["lag_rows"] = " UNION ALL ".join(
    f"SELECT {n} AS lag, f.n, b.r2 AS r2_base, f.r2 AS r2_with_lag, f.b[9] AS lag_coef, f.b[9] / sqrt(f.mse * f.inv[9]) AS t, f.n - 10 AS dof FROM lfull{n} f, lbase{n} b" for n in range(4)
)


@query(
    "ml07_lag_tests",
    f"SELECT lag::BIGINT AS lag, n, {r('r2_base', 'r2_base')}, {r('r2_with_lag', 'r2_with_lag')}, {r('lag_coef', 'lag_coef')}, {r('p', 'p_lag')}, {r('r2_with_lag - r2_base', 'delta_r2')}, p < 0.05 AS significant FROM (SELECT *, {t_tail('t', 'dof')} AS p FROM lag_rows)",
    {**FRAME, **LAG_SQL},
)
def _(t: Tables):
    return fc.lag_tests(train(t), "log_qty", LAG_BASE, "log_mkt_new")


@query(
    "ml08_lag_grid",
    f"SELECT channel, lag, n, {r('CASE WHEN n >= 20 THEN r2 END', 'r2')}, {r('CASE WHEN n >= 20 THEN ' + P + ' END', 'p')} FROM grid",
    {
        **CHANNEL,
        "grid": " UNION ALL ".join(
            f"SELECT {n}::BIGINT AS lag, * FROM ({simple_sql('channel_train', 'log_mkt_new' if n == 0 else f'log_mkt_new_l{n}', 'log_qty', 'channel')})" for n in range(4)
        ),
    },
)
def _(t: Tables):
    return fc.lag_grid(channel_train(t), "channel", "log_qty", "log_mkt_new")


FORECAST = {
    "fc0": "SELECT *, CAST(right(year_month, 2) AS INT) AS mn, row_number() OVER w AS trend, lag(total_sale) OVER w AS sale_lag1, CASE WHEN row_number() OVER w > 3 THEN avg(total_sale) OVER (ORDER BY year_month ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) END AS roll_ma3 FROM monthly_sales WINDOW w AS (ORDER BY year_month)",
    "fc1": f"SELECT *, {CALENDAR_SQL} FROM fc0",
    "fc_train": f"SELECT * FROM fc1 WHERE year_month <= '{TRAIN_END}'",
    **ols("vfit", "fc_train", "total_sale", fc.FORECAST_FEATURES),
    "fc_scored": "SELECT f.*, intercept + " + " + ".join(f"b[{i + 1}] * f.{c}" for i, c in enumerate(fc.FORECAST_FEATURES)) + " AS predicted FROM fc1 f, vfit WHERE roll_ma3 IS NOT NULL",
}


@query(
    "ml09_one_step_scoring",
    f"SELECT year_month, {r('total_sale', 'actual', 1)}, {r('predicted', 'predicted', 1)}, {r('total_sale - predicted', 'error', 1)}, {r('(total_sale - predicted) / total_sale * 100', 'error_pct')}, {r('abs((total_sale - predicted) / total_sale * 100)', 'abs_error_pct')} FROM fc_scored WHERE year_month > '{TRAIN_END}'",
    FORECAST,
)
def _(t: Tables):
    table = fc.volume_forecast(cut_lineage(t.monthly_sales()), TRAIN_END, **DIP)[2]
    return table.withColumns({c: F.round(c, 1) for c in ("actual", "predicted", "error")})


@query(
    "ml10_gain_over_baseline",
    f"""SELECT {r('m', 'model_mape')}, {r('b', 'naive_mape')}, {r('b - m', 'gain_pp')} FROM (SELECT avg(abs(total_sale - predicted) / total_sale) * 100 AS m, avg(abs(total_sale - naive) / total_sale) * 100 AS b
  FROM fc_scored JOIN (SELECT year_month, avg(total_sale) OVER (ORDER BY year_month ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS naive FROM monthly_sales) USING (year_month) WHERE year_month > '{TRAIN_END}')""",
    FORECAST,
)
def _(t: Tables):
    monthly = cut_lineage(t.monthly_sales())
    frame_ = fc.forecast_frame(monthly, **DIP).dropna(subset=fc.FORECAST_FEATURES)
    inside, rest = ser.split_by_month(frame_, TRAIN_END)
    fit = reg.fit_ols(inside, "total_sale", {"volume": fc.FORECAST_FEATURES})
    return fc.baseline_gain(monthly, reg.score_ols(rest, fit, fc.FORECAST_FEATURES), TRAIN_END)


VERDICT = "CASE WHEN r2 < 0.05 THEN 'EXCLUDE: very weak explanatory power' WHEN r2 < 0.1 THEN 'EXCLUDE: weak explanatory power' WHEN p >= 0.05 THEN 'EXCLUDE: not significant' ELSE 'KEEP' END"


@query(
    "ml11_regressor_verdict",
    f"SELECT x, {r('r2', 'r2')}, {r('p', 'p')}, CASE WHEN p < 0.05 THEN 'Yes' ELSE 'No' END AS significant, {VERDICT} AS verdict FROM (SELECT *, {P} AS p FROM simple)",
    {**FRAME, "simple": " UNION ALL ".join(simple_sql("train", x, "total_sale") for x in [*MACROS, "asp", "mkt_new"])},
)
def _(t: Tables):
    fits = reg.simple_ols(train(t), [(x, "total_sale") for x in [*MACROS, "asp", "mkt_new"]])
    significant, verdict = reg.screening_verdict(F.col("r2"), F.col("p"))
    return fits.select("x", "r2", "p", significant.alias("significant"), verdict.alias("verdict"))


@query(
    "ml12_macro_group_grid",
    f"SELECT s.grp, s.x, {r('r2', 'r2')}, {r('p', 'p')}, {r('slope', 'slope', 1)}, {r('mae', 'mae', 1)}, CASE WHEN p < 0.05 THEN 'Yes' ELSE 'No' END AS significant FROM (SELECT *, {P} AS p FROM grid) s JOIN maes m ON m.grp = s.grp AND m.x = s.x",
    {
        "group_rows": f"SELECT g.*, cpi, rate, gdp FROM group_sales g JOIN macro USING (year_month) WHERE year_month <= '{TRAIN_END}'",
        "grid": " UNION ALL ".join(simple_sql("group_rows", x, "qty", "grp") for x in MACROS),
        "maes": " UNION ALL ".join(f"SELECT a.grp, '{x}' AS x, avg(abs(qty - intercept - slope * {x})) AS mae FROM group_rows a JOIN grid b ON b.grp = a.grp AND b.x = '{x}' GROUP BY 1" for x in MACROS),
    },
)
def _(t: Tables):
    rows = t.group_sales().join(t.macro().select("year_month", *MACROS), "year_month").filter(F.col("year_month") <= TRAIN_END)
    out = fc.screen_regressors(rows, MACROS, ["qty"], ["grp"])
    return out.select("grp", "x", "r2", "p", F.round("slope", 1).alias("slope"), F.round("mae", 1).alias("mae"), "significant")


DRIVER_FEATURES = [*fc.BASE, "log_asp"]


@query(
    "ml13_dominant_driver",
    f"SELECT channel, arg_max(feature, abs(beta)) AS driver, {r('arg_max(beta, abs(beta))', 'beta')} FROM betas GROUP BY 1",
    {**CHANNEL, "betas": " UNION ALL ".join(f"SELECT channel, '{f}' AS feature, corr(log_qty, {f}) AS beta FROM channel_train GROUP BY 1" for f in DRIVER_FEATURES)},
)
def _(t: Tables):
    return reg.dominant_driver(channel_train(t), "log_qty", DRIVER_FEATURES, ["channel"])


@query(
    "so06_arg_max_feature",
    f"SELECT arg_max(feature, abs(beta)) AS driver, {r('arg_max(beta, abs(beta))', 'beta')} FROM betas",
    {**FRAME, "betas": " UNION ALL ".join(f"SELECT '{f}' AS feature, corr(log_qty, {f}) AS beta FROM train" for f in DRIVER_FEATURES)},
)
def _(t: Tables):
    return reg.dominant_driver(train(t), "log_qty", DRIVER_FEATURES)


# --- plans ------------------------------------------------------------------------------------------------------


@query(
    "dp13_model_frame",
    f"SELECT year_month, trend, {r('sin_12', 'sin_12')}, {r('cos_12', 'cos_12')}, {r('sin_6', 'sin_6')}, covid_dip::BIGINT AS covid_dip, yearend::BIGINT AS yearend, tet_feb::BIGINT AS tet_feb, {r('log_qty', 'log_qty')}, {r('log_asp', 'log_asp')}, {r('log_mkt_new', 'log_mkt_new')}, {r('log_mkt_new_l1', 'log_mkt_new_l1')}, {r('log_mkt_new_l3', 'log_mkt_new_l3')} FROM lagged",
    FRAME,
)
def _(t: Tables):
    return frame(t).select("year_month", "trend", "sin_12", "cos_12", "sin_6", "covid_dip", "yearend", "tet_feb", "log_qty", "log_asp", "log_mkt_new", "log_mkt_new_l1", "log_mkt_new_l3")


@query(
    "dp15_spend_regression",
    f"SELECT x, y, n, {r('slope', 'slope')}, {r('intercept', 'intercept', 1)}, {r('r2', 'r2')}, {r(P, 'p')} FROM simple",
    {
        "spend": "SELECT '20' || split_part(period, '-', 2) || '-' || lpad(split_part(period, '-', 1), 2, '0') AS year_month, CAST(sum(amount) AS DOUBLE) AS marketing_spend FROM mkt_ledger WHERE account = 'A' AND amount > 0 AND period LIKE '%-%' GROUP BY 1",
        "spend_rows": "SELECT total_sale, marketing_spend FROM monthly_sales m JOIN spend s ON CAST(left(s.year_month, 4) AS INT) - 2000 = (CAST(left(m.year_month, 4) AS INT) % 100 + 20) AND right(s.year_month, 2) = right(m.year_month, 2)",
        "simple": simple_sql("spend_rows", "marketing_spend", "total_sale"),
    },
)
def _(t: Tables):
    # the ledger periods carry a two-digit year, so the sales months are moved onto the same calendar
    year = F.substring("year_month", 1, 4).cast("int") % 100 + 20
    sales = t.monthly_sales().withColumn("_y", year).select(
        F.concat(F.lit("20"), F.col("_y").cast("string"), F.substring("year_month", 5, 3)).alias("year_month"), "total_sale"
    )
    out = fc.spend_regression(sales, t.mkt_ledger().filter("account = 'A'"))
    return out.select("x", "y", "n", "slope", F.round("intercept", 1).alias("intercept"), "r2", "p")


@query(
    "dp16_volume_forecast",
    f"SELECT n, {r('1 - sum_sq / (n * v)', 'r2')}, {r('mae', 'mae', 1)}, {r('mape', 'mape')}, {r('val_mape', 'val_mape')} FROM (SELECT count(*) AS n, sum(pow(total_sale - predicted, 2)) AS sum_sq, var_pop(total_sale) AS v, avg(abs(total_sale - predicted)) AS mae, avg(abs(total_sale - predicted) / total_sale) * 100 AS mape FROM fc_scored WHERE year_month <= '{TRAIN_END}'), (SELECT avg(abs(total_sale - predicted) / total_sale) * 100 AS val_mape FROM fc_scored WHERE year_month > '{TRAIN_END}')",
    FORECAST,
)
def _(t: Tables):
    _, inside, table = fc.volume_forecast(cut_lineage(t.monthly_sales()), TRAIN_END, **DIP)
    return inside.select("n", "r2", F.round("mae", 1).alias("mae"), "mape", table.select(F.avg("abs_error_pct")).scalar().alias("val_mape"))


@query(
    "dp17_macro_screening",
    f"""SELECT x, {r('r2', 'r2')}, {r('p', 'p')}, {r('slope', 'slope', 1)}, {r('f', 'f_stat')}, {r('mae', 'mae', 1)}, CASE WHEN p < 0.05 THEN 'Yes' ELSE 'No' END AS significant, CASE WHEN x <> 'all' THEN {VERDICT} WHEN r2 < 0.2 THEN 'EXCLUDE: combined R2 too low' WHEN p < 0.05 THEN 'KEEP' ELSE 'EXCLUDE: not significant' END AS verdict FROM
  (SELECT s.x, r2, {P} AS p, slope, r2 / (1 - r2) * (n - 2) AS f, mae FROM simple s JOIN maes m ON m.x = s.x UNION ALL SELECT 'all', r2, {f_tail('f_stat', '3', 'n - 4')}, NULL, f_stat,
    (SELECT avg(abs(total_sale - intercept - b[1] * cpi - b[2] * rate - b[3] * gdp)) FROM train, fit) FROM fit)""",
    {
        **FRAME,
        **ols("fit", "train", "total_sale", MACROS),
        "simple": " UNION ALL ".join(simple_sql("train", x, "total_sale") for x in MACROS),
        "maes": " UNION ALL ".join(f"SELECT '{x}' AS x, avg(abs(total_sale - intercept - slope * {x})) AS mae FROM train JOIN simple b ON b.x = '{x}'" for x in MACROS),
    },
)
def _(t: Tables):
    return fc.macro_screening(train(t), MACROS).withColumns({c: F.round(c, 1) for c in ("slope", "mae")})
