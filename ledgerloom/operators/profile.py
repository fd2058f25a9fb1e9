"""Profiles of a table: medians, frequencies, missing values, outliers, group means, correlations, t-tests."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.nulls import ratio, safe_pct
from ledgerloom.functions.stats import pearson, t_pvalue
from ledgerloom.operators.ranks import quantiles


def stacked(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(column, value) rows of several numeric columns."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    return df.select(*keep, F.inline(F.array(*cells)))


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: dict[str, float], groups: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles of several columns in one pass: one row per group and column."""
    return quantiles(stacked(df, columns, groups), [*groups, "column"], "value", probs)


def fill_medians(df: DataFrame, columns: Sequence[str], source: DataFrame | None = None) -> DataFrame:
    """NULLs replaced by the median of the column in `source` (default: the rows themselves)."""
    found = column_quantiles(source if source is not None else df, columns, {"median": 0.5})
    box = found.select(F.map_from_entries(F.collect_list(F.struct("column", "median")))).scalar()
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.try_element_at(box, F.lit(c))) for c in columns}
    )


def group_medians(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """One row per group, one median column per input column."""
    found = column_quantiles(df, columns, {"median": 0.5}, [group])
    return found.groupBy(group).agg(
        *[F.max(F.when(F.col("column") == c, F.col("median"))).alias(f"median_{c}") for c in columns]
    )


def frequencies(df: DataFrame, column: str) -> DataFrame:
    """Value counts, NULL included."""
    return df.groupBy(column).agg(F.count("*").alias("n"))


def modes(df: DataFrame, groups: Sequence[str], column: str, name: str) -> DataFrame:
    """Most frequent non-NULL value per group, ties to the smaller value: counts first, then one row per value."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(*groups, column).agg(F.count("*").alias("_n"))
    return counts.groupBy(*groups).agg(F.min_by(column, F.struct(-F.col("_n"), F.col(column))).alias(name))


def group_means(df: DataFrame, groups: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*groups).agg(F.count("*").alias("n"), *[F.avg(c).alias(f"avg_{c}") for c in columns])


def binned_shares(df: DataFrame, group: str, column: str, width: float) -> DataFrame:
    """Share in percent of each bin of a class; the window runs over the counted bins."""
    start = (F.floor(F.col(column) / width) * width).alias("bin_start")
    bins = df.filter(F.col(column).isNotNull()).groupBy(group, start).agg(F.count("*").alias("n"))
    return bins.withColumn("share_pct", safe_pct(F.col("n"), F.sum("n").over(Window.partitionBy(group))))


def event_rate(df: DataFrame, level: str, flag: str) -> DataFrame:
    return df.groupBy(level).agg(F.count("*").alias("n"), (F.avg(flag) * 100).alias("rate_pct"))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, all pairs in one aggregate."""
    pairs = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), pearson(F.col(a), F.col(b)).alias("r"))
        for a, b in combinations(columns, 2)
    ]
    return df.agg(F.array(*pairs).alias("_p")).select(F.inline("_p"))


def without_collinear(df: DataFrame, columns: Sequence[str], threshold: float = 0.8) -> list[str]:
    """Columns left after dropping, in order, each one correlated above the threshold with a kept one.

    Only the table of column pairs reaches the driver.
    """
    r = {(row["a"], row["b"]): row["r"] for row in correlations(df, columns).collect()}
    kept: list[str] = []
    for c in columns:
        if all(abs(r[(k, c)] or 0.0) <= threshold for k in kept):
            kept.append(c)
    return kept


def missing_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, missing values, quartiles, 1.5-IQR fences and outliers per column."""
    fences = column_quantiles(df, columns, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    spread = F.col("q3") - F.col("q1")
    fences = fences.withColumn("low", F.col("q1") - 1.5 * spread).withColumn("high", F.col("q3") + 1.5 * spread)
    names = ("q1", "median", "q3", "low", "high")
    box = fences.select(F.map_from_entries(F.collect_list(F.struct(F.col("column"), F.struct(*names))))).scalar()
    limit = F.try_element_at(box, F.col("column"))
    outside = (F.col("value") < limit["low"]) | (F.col("value") > limit["high"])
    counts = stacked(df, columns).groupBy("column").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("value").isNull()).alias("missing"),
        F.count_if(outside).alias("outliers"),
    )
    return counts.select("*", *[limit[c].alias(c) for c in names])


def t_test(df: DataFrame, group: str, first: str, second: str, value: str) -> DataFrame:
    """Two-sample t-test of `value` between two groups: pooled and Welch statistic, degrees of freedom, p."""
    side = lambda g, name: [
        F.count(F.when(F.col(group) == g, F.col(value))).alias(f"n{name}"),
        F.avg(F.when(F.col(group) == g, F.col(value))).alias(f"m{name}"),
        F.var_samp(F.when(F.col(group) == g, F.col(value))).alias(f"v{name}"),
    ]
    row = df.agg(*side(first, "1"), *side(second, "2"))
    n1, n2, v1, v2 = (F.col(c) for c in ("n1", "n2", "v1", "v2"))
    gap = F.col("m1") - F.col("m2")
    pooled = ((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)
    a, b = v1 / n1, v2 / n2
    out = row.select(
        "n1", "n2", F.col("m1").alias("mean1"), F.col("m2").alias("mean2"),
        ratio(gap, F.sqrt(pooled * (1 / n1 + 1 / n2))).alias("t_pooled"),
        (n1 + n2 - 2).cast("double").alias("dof_pooled"),
        ratio(gap, F.sqrt(a + b)).alias("t_welch"),
        ((a + b) * (a + b) / (a * a / (n1 - 1) + b * b / (n2 - 1))).alias("dof_welch"),
    )
    p = {f"p_{k}": t_pvalue(f"t_{k}", f"dof_{k}") for k in ("pooled", "welch")}
    out = out.withColumns(p)
    return out.withColumn("significant", F.col("p_welch") < 0.05)


def workload_flag(hours: Column, limit: float = 175) -> Column:
    return (hours > limit).cast("int")


def tenure_bucket(years: Column, edges: Sequence[int] = (2, 4, 6)) -> Column:
    """'<2', '2-3', '4-5', '6+' for the default edges; NULL stays NULL."""
    out = F.when(years < edges[0], f"<{edges[0]}")
    for low, high in zip(edges, edges[1:]):
        out = out.when(years < high, f"{low}-{high - 1}")
    return out.when(years.isNotNull(), f"{edges[-1]}+")
