"""Cost-variance measures over ledger postings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.nulls import nz, ratio, safe_pct
from ledgerloom.functions.periods import month_text
from ledgerloom.operators.relational import with_previous_period

POSTED = "dd/MM/yyyy"


def posting_month(text_date: Column) -> Column:
    return month_text(F.to_date(text_date, POSTED))


def net_cost(keys: Sequence[str | Column], entries: DataFrame) -> DataFrame:
    """Debit minus credit per key; a missing side counts as 0."""
    return entries.groupBy(*keys).agg(
        (nz(F.sum("accounted_dr")) - nz(F.sum("accounted_cr"))).alias("net_cost")
    )


def monthly_net_cost(entries: DataFrame, keys: Sequence[str] = ("segment5",)) -> DataFrame:
    return net_cost([*keys, posting_month(F.col("effective_date")).alias("year_month")], entries)


def subtotals(costs: DataFrame, levels: Sequence[str], value: str) -> DataFrame:
    """Rollup over the levels with `level_id` (0 = finest, all ones = grand total).

    Sums add up, so the rows are summed at the finest level before the rollup expands them.
    """
    finest = costs.groupBy(*levels).agg(F.sum(value).alias(value))
    return finest.rollup(*levels).agg(F.sum(value).alias(value), F.grouping_id().alias("level_id"))


def unit_ratio(
    costs: DataFrame, volumes: DataFrame, keys: Sequence[str], cost: str, base: str, name: str, percent: bool = False
) -> DataFrame:
    """Total cost over total base (weight, revenue) per key; the two facts are aggregated before they meet."""
    top = costs.groupBy(*keys).agg(F.sum(cost).alias(cost))
    bottom = volumes.groupBy(*keys).agg(F.sum(base).alias(base))
    quotient = (safe_pct if percent else ratio)(F.col(cost), F.col(base))
    return top.join(bottom, list(keys), "left").withColumn(name, quotient)


def year_to_date(monthly: DataFrame, keys: Sequence[str], value: str, name: str = "ytd") -> DataFrame:
    """Cumulative value within key and year: at most twelve rows per window."""
    window = (
        Window.partitionBy(*keys, F.substring("year_month", 1, 4))
        .orderBy("year_month")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return monthly.withColumn(name, F.sum(value).over(window))


def year_on_year(monthly: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Change against the same month a year earlier, absolute and in percent; NULL where there is none."""
    out = with_previous_period(monthly, keys, "year_month", {value: "prior_year"}, lag=12)
    change = F.col(value) - F.col("prior_year")
    return out.withColumn("yoy", change).withColumn("yoy_pct", safe_pct(change, F.col("prior_year")))


def share_of_total(totals: DataFrame, value: str, name: str = "share_pct") -> DataFrame:
    """Percentage of the grand total, which comes in as a scalar subquery, not through one big window."""
    whole = totals.select(F.sum(value)).scalar()
    return totals.withColumn(name, safe_pct(F.col(value), whole))


def variance_bridge(totals: DataFrame, unit: str, prior: str, current: str) -> DataFrame:
    """Waterfall: prior total, one step per unit, current total, with the running level.

    `totals` holds one row per organisational unit, so the ordered window stays small.
    """
    units = totals.select(
        F.lit(1).alias("step"), F.col(unit).alias("label"), (nz(F.col(current)) - nz(F.col(prior))).alias("delta")
    )
    start = totals.select(F.lit(0).alias("step"), F.lit("prior").alias("label"), nz(F.sum(prior)).alias("delta"))
    steps = start.unionByName(units)
    level = Window.orderBy("step", "label").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = steps.withColumn("level", F.sum("delta").over(level))
    end = totals.select(
        F.lit(2).alias("step"), F.lit("current").alias("label"), F.lit(0).alias("delta"), nz(F.sum(current)).alias("level")
    )
    return steps.unionByName(end)


def star_join(facts: DataFrame, dimensions: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Left joins with dimensions that have one row per key; small ones are broadcast by the optimizer."""
    for frame, key in dimensions:
        facts = facts.join(frame, key, "left")
    return facts


def cost_pack(entries: DataFrame, unit: str = "unit") -> DataFrame:
    """Unit x month: net cost, year to date, year on year, share of the month, cost per kg, cost as % of revenue.

    Cost, weight and revenue come from one aggregate; everything else works on its unit x month rows, which one
    shuffle by unit serves for both the year-on-year and the year-to-date window.
    """
    monthly = entries.groupBy(unit, posting_month(F.col("effective_date")).alias("year_month")).agg(
        (nz(F.sum("accounted_dr")) - nz(F.sum("accounted_cr"))).alias("net_cost"),
        F.sum("qty_kg").alias("qty_kg"),
        F.sum("revenue").alias("revenue"),
    )
    out = year_to_date(year_on_year(monthly, [unit], "net_cost"), [unit], "net_cost")
    month_total = F.sum("net_cost").over(Window.partitionBy("year_month"))
    return out.select(
        unit,
        "year_month",
        "net_cost",
        "ytd",
        "yoy",
        "yoy_pct",
        safe_pct(F.col("net_cost"), month_total).alias("share_pct"),
        ratio(F.col("net_cost"), F.col("qty_kg")).alias("cost_per_kg"),
        safe_pct(F.col("net_cost"), F.col("revenue")).alias("cost_pct_revenue"),
    )
