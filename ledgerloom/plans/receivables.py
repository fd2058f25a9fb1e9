"""Monthly receivable load and its reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import credit
from ledgerloom.functions.nulls import nz, presence_flag
from ledgerloom.functions.periods import DOT, month_end, month_text, previous_month_end, shift_literal, trailing_months
from ledgerloom.operators.relational import latest_per_key
from ledgerloom.sources.sinks import rewrite_months, update_matched

KEY = "skp_credit_case"
MEASURES = ("principal", "interest", "penalty")

# Fixed value: first write-down month taken into account.
WRITE_DOWN_FROM = "2019.07"


def stage_from_deterioration(deter: DataFrame, mo: str) -> DataFrame:
    """Contract stages dated on the last day of the month before `mo`."""
    day = F.to_date("date_balance")
    return deter.filter(day == previous_month_end(mo)).select(
        KEY,
        "skp_credit_type",
        day.alias("date_balance"),
        credit.deterioration_stage(F.col("flag_deterioration")).alias("stage_split"),
    )


def latest_application(application: DataFrame, tie: str | None = None) -> DataFrame:
    """Latest application of every contract that is not deleted: contract, acquisition class."""
    kept = application.filter(F.col("flag_deleted") == "N")
    order = ["dtime_proposal"] + ([tie] if tie else ["skp_class_status_acquisition"])
    return latest_per_key(kept, [KEY], order, ["skp_class_status_acquisition"])


def daily_writeoff(writeoff_acc_dd: DataFrame, mo: str, keep_zero: bool = True) -> DataFrame:
    """Contract numbers with a daily write-off up to the month; the balances are zeros unless `keep_zero` is off."""
    rows = writeoff_acc_dd.filter(F.col("mo") <= mo)
    names = ("sum_176", "sum_177", "sum_178")
    if keep_zero:
        keys = rows.select("text_contract_number").distinct()
        return keys.select("*", *[F.lit(0).cast("decimal(38,2)").alias(n) for n in names])
    return rows.groupBy("text_contract_number").agg(*[F.sum(n).alias(n) for n in names])


def month_adjustments(cre_adjustment: DataFrame, mo: str) -> DataFrame:
    """Movements of the month per contract: principal and interest."""
    rows = cre_adjustment.filter(F.col("mo") == mo)
    return rows.groupBy(KEY).agg(
        F.sum(credit.moved_principal()).alias("adj_principal"), F.sum(credit.moved_interest()).alias("adj_interest")
    )


def monthly_overview(
    source: DataFrame,
    contract: DataFrame,
    history: DataFrame,
    contract_stage: DataFrame,
    covid_flag: DataFrame,
    writeoff_acc_dd: DataFrame,
    writeoff_acc: DataFrame,
    cre_adjustment: DataFrame,
    mo: str,
    daily_writeoff_balances: bool = False,
    covid_new: str = "month",
    covid_continuing: str = "last_day",
) -> DataFrame:
    """Overview rows of one month.

    A contract without a row in the previous month of `history` is new: it keeps its source bucket and has no
    previous bucket. Any other contract continues: its bucket is recomputed, the previous one carried, and source
    'abnc' rows are dropped. Both kinds come from one pass over the source, told apart by the outer join with the
    previous month. Every joined side is reduced to one row per key first, so nothing is multiplied; the reduction
    shuffles on the join key and the join reuses that partitioning. Write-offs are stored by contract number: the
    few of the month get their contract key first, so that the source itself is shuffled by one key only.
    """
    masters = contract.select(KEY, "text_contract_number", "code_accounting_method", "type_product")
    numbers = masters.select(KEY, "text_contract_number")
    previous = history.filter(F.col("mo") == shift_literal(mo, -1)).select(
        KEY, F.col("code_cross").alias("code_cross_previous"), F.lit(True).alias("_known")
    )
    stages = (
        contract_stage.filter(F.to_date("date_balance") == previous_month_end(mo))
        .groupBy(KEY)
        .agg(F.max("stage_split").alias("_stage"))
    )
    day = F.to_date("date_application")
    covid = (
        covid_flag.filter((F.col("flag_covid") == 1) & (month_text(day, DOT) == mo))
        .groupBy(KEY)
        .agg(F.lit(True).alias("_covid_month"), F.max(day == month_end(mo)).alias("_covid_last_day"))
    )
    written = (
        writeoff_acc.filter(F.col("mo") == mo)
        .groupBy("text_contract_number")
        .agg(*[F.sum(f"amt_{m}").alias(f"_wo_{m}") for m in MEASURES])
        .join(numbers, "text_contract_number")
        .drop("text_contract_number")
    )
    rows = (
        source.filter((F.col("mo") == mo) & ~F.col("skp_credit_status").isin(*credit.EXCLUDED_STATUSES))
        .join(masters.drop("text_contract_number"), KEY)
        .join(previous, KEY, "left")
        .join(stages, KEY, "left")
        .join(covid, KEY, "left")
        .join(month_adjustments(cre_adjustment, mo), KEY, "left")
        .join(written, KEY, "left")
    )
    if daily_writeoff_balances:
        daily = daily_writeoff(writeoff_acc_dd, mo, keep_zero=False).join(numbers, "text_contract_number")
        rows = rows.join(daily.drop("text_contract_number"), KEY, "left")
        added = [F.col(f"sum_{n}") for n in (176, 177, 178)]
    else:
        added = [F.lit(0)] * 3

    known = F.coalesce(F.col("_known"), F.lit(False))
    rows = rows.filter(~known | ~F.col("code_cross").like("%abnc"))
    hit = {
        "month": F.coalesce("_covid_month", F.lit(False)),
        "last_day": F.coalesce("_covid_last_day", F.lit(False)),
    }
    is_covid = F.when(known, hit[covid_continuing]).otherwise(hit[covid_new])
    recomputed = credit.dpd_bucket(F.col("code_accounting_method"), F.col("dpd"))
    return rows.select(
        F.col("mo"),
        KEY,
        F.when(known, recomputed).otherwise(F.col("code_cross")).alias("code_cross"),
        credit.product_type(F.col("code_accounting_method"), F.col("type_product")).alias("type_product"),
        credit.net_balance(F.col("amt_principal"), added[0], F.col("_wo_principal"), F.col("adj_principal")).alias(
            "amt_principal_outstanding"
        ),
        credit.net_balance(F.col("amt_interest"), added[1], F.col("_wo_interest")).alias("amt_interest"),
        credit.net_balance(F.col("amt_penalty"), added[2], F.col("_wo_penalty")).alias("amt_penalty"),
        F.col("dpd_original").alias("dpd"),
        F.col("code_cross_previous"),
        F.col("skp_credit_status"),
        F.lit("Y").alias("code_status"),
        credit.stage(F.col("dpd"), is_covid, F.col("_stage")).alias("stage_split"),
        presence_flag(F.when(is_covid, F.lit(1))).alias("flag_covid"),
    )


def override_stages(
    overview: DataFrame, industry_covid: DataFrame, writeoff: DataFrame, mo: str, write_down_from: str = WRITE_DOWN_FROM
) -> DataFrame:
    """Industry impact moves stage 1 to stage 2, then a write-down up to the row's month moves to 'write down'."""
    impacted = industry_covid.filter(
        (F.to_date("date_balance") == month_end(mo)) & (F.col("impact_by_covid") == 1)
    )
    this_month = F.col("mo") == mo
    out = update_matched(
        overview, impacted, [KEY], {"stage_split": F.lit("stage 2")}, this_month & (F.col("stage_split") == "stage 1")
    )
    written = writeoff.filter(F.col("mo").between(write_down_from, mo))
    return update_matched(out, written, [KEY], {"stage_split": F.lit("write down")}, this_month)


def override_stored_stages(
    overview: DataFrame,
    industry_covid: DataFrame,
    writeoff: DataFrame,
    mo: str,
    swap: Callable[[DataFrame], None],
    write_down_from: str = WRITE_DOWN_FROM,
    month: str = "mo",
) -> list:
    """`override_stages` on a stored overview: its month is rewritten, if it has rows, and no other; see `sinks.rewrite_months`."""
    touched = overview.filter(F.col(month) == mo).limit(1)
    change = lambda rows: override_stages(rows, industry_covid, writeoff, mo, write_down_from)
    return rewrite_months(overview, touched, change, swap, month)


def write_down_month(writeoff: DataFrame) -> DataFrame:
    """(contract, wdm): the first month in which a contract was written down, so that a second one multiplies no balance."""
    return writeoff.groupBy(KEY).agg(F.min("mo").alias("wdm"))


def _report_rows(overview, contract, writeoff, application, months: Column, written: Column, tie):
    """Reported overview rows with write-down month and segment."""
    products = contract.filter(~F.col("code_product").isin(*credit.EXCLUDED_PRODUCTS)).select(KEY)
    return (
        overview.filter((F.col("code_status") == "Y") & months)
        .join(products, KEY)
        .join(write_down_month(writeoff.filter(written)), KEY, "left")
        .join(latest_application(application, tie), KEY, "left")
        .withColumn("segment", credit.acquisition_segment(F.col("skp_class_status_acquisition")))
    )


def receivable_trend(
    overview: DataFrame,
    contract: DataFrame,
    writeoff: DataFrame,
    application: DataFrame,
    mo: str,
    months: int = 6,
    write_down_from: str = WRITE_DOWN_FROM,
    tie: str | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Measure x product x bucket x segment with one column per month, latest first.

    One aggregate does the grouping, the unpivot and the pivot: every month and measure is a conditional sum. A
    measure row appears when at least one month has a non-NULL sum, as after an unpivot that excludes NULLs.
    """
    window = trailing_months(mo, months)
    rows = _report_rows(
        overview,
        contract,
        writeoff,
        application,
        F.col("mo").between(window[-1], mo),
        F.col("mo").between(write_down_from, mo),
        tie,
    )
    dims = ["type_product", "code_cross", "code_cross_previous", "wdm", "flag_covid", "segment"]
    source = {"principal": "amt_principal_outstanding", "interest": "amt_interest", "penalty": "amt_penalty"}
    names = ["latest_month"] + [f"latest_month_{i}" for i in range(1, months)]
    sums = [
        F.sum(F.when(F.col("mo") == m, F.col(col))).alias(f"{measure}_{name}")
        for measure, col in source.items()
        for m, name in zip(window, names)
    ]
    wide = rows.groupBy(*dims).agg(*sums)
    per_measure = F.array(
        *[
            F.struct(
                F.lit(measure.upper()).alias("measures"),
                F.lit(rank).alias("_order"),
                *[F.col(f"{measure}_{name}").alias(name) for name in names],
            )
            for rank, measure in enumerate(source)
        ]
    )
    out = wide.select(*dims, F.inline(per_measure)).filter(F.coalesce(*names).isNotNull())
    if ordered:
        out = out.orderBy(*report_order("_order", "type_product", "code_cross", "code_cross_previous"))
    return out.select(
        "measures",
        F.col("type_product").alias("prod"),
        F.col("code_cross").alias("bucket"),
        F.col("code_cross_previous").alias("bucket_pre"),
        "wdm",
        F.col("flag_covid").alias("covid"),
        "segment",
        *[nz(F.col(n)).alias(n) for n in names],
    )


def report_order(measure_rank: str, product: str, bucket: str, bucket_pre: str) -> list[Column]:
    """Measure, product, then buckets in numeric order; NULLs last."""
    return [
        F.col(measure_rank),
        F.col(product).asc_nulls_last(),
        credit.bucket_rank(F.col(bucket)).asc_nulls_last(),
        credit.bucket_rank(F.col(bucket_pre)).asc_nulls_last(),
    ]


def receivables_by_stage(
    overview: DataFrame,
    contract: DataFrame,
    writeoff: DataFrame,
    application: DataFrame,
    mo: str,
    write_down_from: str = WRITE_DOWN_FROM,
    write_down_to: str | None = None,
    tie: str | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Balances of one month by product, bucket, write-down month, stage, covid flag and segment."""
    written = F.col("mo") >= write_down_from
    if write_down_to is not None:
        written = written & (F.col("mo") <= write_down_to)
    rows = _report_rows(overview, contract, writeoff, application, F.col("mo") == mo, written, tie)
    out = rows.groupBy(
        F.col("type_product").alias("prod"),
        F.col("code_cross").alias("bucket"),
        "mo",
        "wdm",
        F.col("stage_split").alias("stage"),
        F.col("flag_covid").alias("covid"),
        "segment",
    ).agg(
        F.sum("amt_principal_outstanding").alias("principal"),
        F.sum("amt_interest").alias("interest"),
        F.sum("amt_penalty").alias("penalty"),
    )
    return out.orderBy(*[F.col(c).asc_nulls_last() for c in ("prod", "bucket", "mo")]) if ordered else out
