"""Provision movement of written-down contracts between two months."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import credit
from ledgerloom.functions.nulls import nz
from ledgerloom.plans.receivables import KEY, latest_application, write_down_month


@dataclass(frozen=True)
class Segment:
    name: str
    method: str
    acquisition: int | None = None
    keeps_excluded_products: bool = False


# The nine reporting segments.
SEGMENTS = (
    Segment("CD-ACQ", "CD", 5),
    Segment("CD-NONACQ", "CD", 2),
    Segment("TW", "TW", None, True),
    Segment("CLXS-ACQ", "CL", 5),
    Segment("CLXS-NONACQ", "CL", 2),
    Segment("CLWI-ACQ", "CLW", 5),
    Segment("CLWI-NONACQ", "CLW", 2),
    Segment("REL", "REL"),
    Segment("RM", "RM"),
)

# Fixed value: write-downs must be later than this month.
WRITE_DOWN_AFTER = "2019.06"


def segment_name(method: Column, acquisition: Column, segments=SEGMENTS) -> Column:
    out = None
    for s in segments:
        rule = method == s.method
        if s.acquisition is not None:
            rule = rule & (acquisition == s.acquisition)
        out = F.when(rule, s.name) if out is None else out.when(rule, s.name)
    return out


def written_down_snapshot(
    overview: DataFrame,
    contract: DataFrame,
    application: DataFrame,
    rates: DataFrame,
    writeoff: DataFrame,
    months: list[str],
    write_down_after: str = WRITE_DOWN_AFTER,
    segments=SEGMENTS,
    tie: str | None = None,
) -> DataFrame:
    """Contract x month rows of the given months: write-down month, bucket, exposure and provision.

    The overview is read by its month partitions. The rate table is joined on a precomputed key, left to the
    optimizer to broadcast when it is small; it has one rate per key and month, a second one would double the rows. A
    contract counts once, by its first write-down. Excluded products stay only in the methods whose segment keeps them.
    """
    keeping = [s.method for s in segments if s.keeps_excluded_products]
    allowed = ~F.col("code_product").isin(*credit.EXCLUDED_PRODUCTS)
    if keeping:
        allowed = allowed | F.col("code_accounting_method").isin(*keeping)
    contracts = contract.filter(F.col("code_accounting_method").isin(*{s.method for s in segments}) & allowed).select(
        KEY, "text_contract_number", "code_accounting_method", "type_product"
    )
    amount = credit.exposure(F.col("amt_principal_outstanding"), F.col("amt_interest"), F.col("amt_penalty"))
    written = write_down_month(writeoff.filter(F.col("mo") > write_down_after))
    rows = (
        overview.filter(F.col("mo").isin(*months))
        .select(KEY, "mo", "code_cross", amount.alias("balance"))
        .join(contracts, KEY)
        .join(written, KEY)
        .filter(F.col("mo") >= F.col("wdm"))
        .join(latest_application(application, tie), KEY, "left")
        .withColumn(
            "_rate_key", credit.rate_key(F.col("code_accounting_method"), F.col("type_product"), F.col("code_cross"))
        )
    )
    priced = rates.select(
        F.col("code_cross").alias("_rate_key"), "mo", F.col("rate_provisioning_stage_2_3").alias("_rate")
    )
    return rows.join(priced, ["_rate_key", "mo"], "left").select(
        KEY,
        "mo",
        "wdm",
        "text_contract_number",
        "skp_class_status_acquisition",
        "code_accounting_method",
        "type_product",
        "code_cross",
        "balance",
        credit.provision(F.col("_rate"), F.col("balance")).alias("provision"),
    )


def provision_movement(
    overview: DataFrame,
    contract: DataFrame,
    application: DataFrame,
    rates: DataFrame,
    writeoff: DataFrame,
    prior: str,
    current: str,
    write_down_after: str = WRITE_DOWN_AFTER,
    segments=SEGMENTS,
    tie: str | None = None,
    match: str = "text_contract_number",
) -> DataFrame:
    """Movement rows of all segments in one pass, with the segment as a column.

    Prior and current snapshot are matched by contract number in a full outer join; a contract number stands for
    one contract, so method and excluded product are the same on both sides. With `match` = the contract key, tables
    bucketed by that key (`sources.history`) are joined without a shuffle. Each side is the same plan with its
    own month, which reaches the overview scan (one partition per side); the contract, application, rate and
    write-off subplans are equal on both sides, so their exchanges are computed once and reused.
    """

    rows = written_down_snapshot(
        overview, contract, application, rates, writeoff, [prior, current], write_down_after, segments, tie
    )
    if match not in ("text_contract_number", KEY):
        raise ValueError(f"match by text_contract_number or {KEY}")

    def snapshot(month: str, suffix: str) -> DataFrame:
        side = rows.filter(F.col("mo") == month)
        return side.select(match, *[F.col(c).alias(f"{c}_{suffix}") for c in rows.columns if c not in ("mo", match)])

    both = snapshot(prior, "pre").join(snapshot(current, "cur"), match, "full_outer")
    if match == KEY:
        both = both.withColumn("text_contract_number", F.coalesce("text_contract_number_pre", "text_contract_number_cur"))
    method = F.coalesce("code_accounting_method_pre", "code_accounting_method_cur")
    acquisition = F.coalesce("skp_class_status_acquisition_cur", "skp_class_status_acquisition_pre")
    name = segment_name(method, acquisition, segments)
    sub_type = credit.card_type(F.coalesce("type_product_pre", "type_product_cur"))
    return both.filter(name.isNotNull() & (nz(F.col("balance_pre")) + nz(F.col("balance_cur")) != 0)).select(
        name.alias("segment"),
        F.when(method == "REL", sub_type).alias("type_product"),
        "text_contract_number",
        F.coalesce("wdm_pre", "wdm_cur").alias("wdm"),
        F.coalesce("code_cross_pre", F.lit("New WD")).alias("code_cross_pre"),
        nz(F.col("balance_pre")).alias("balance_pre"),
        nz(F.col("provision_pre")).alias("provision_pre"),
        F.coalesce("code_cross_cur", F.lit("Finished")).alias("code_cross_cur"),
        nz(F.col("balance_cur")).alias("balance_cur"),
        nz(F.col("provision_cur")).alias("provision_cur"),
        (nz(F.col("provision_cur")) - nz(F.col("provision_pre"))).alias("provision_var"),
        credit.movement_class(F.col("code_cross_pre"), F.col("provision_pre"), F.col("provision_cur")).alias(
            "movement"
        ),
    )


def segment_movement(movement: DataFrame, segment: str) -> DataFrame:
    """One segment as the report shows it; REL leads with its sub-type and is ordered by it."""
    rows = movement.filter(F.col("segment") == segment).drop("segment")
    return rows.orderBy("type_product") if segment == "REL" else rows.drop("type_product")


def movement_summary(movement: DataFrame) -> DataFrame:
    """Contracts and provision variance by segment and movement class."""
    return movement.groupBy("segment", "movement").agg(
        F.count("*").alias("n_contracts"),
        F.sum("provision_var").alias("sum_variance"),
        F.sum("balance_pre").alias("sum_balance_pre"),
        F.sum("balance_cur").alias("sum_balance_cur"),
    )
