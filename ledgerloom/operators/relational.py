"""Joins, record selection, reshaping and key sets used by the plans."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.periods import DASH, month_index


def left_join_filtered(left: DataFrame, right: DataFrame, on: Sequence[str], where: Column) -> DataFrame:
    """Left join whose build-side predicates are applied to the right side before the join."""
    return left.join(right.filter(where), list(on), "left")


def without_match(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right.select(*on), list(on), "left_anti")


def with_match(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right.select(*on), list(on), "left_semi")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """The row with the greatest `order` values per key; later order columns break ties.

    An aggregate with map-side combine: a key holding a third of the rows costs one row per input partition in the
    shuffle, where a row_number window would sort all of them in one task.
    """
    picked = F.max_by(F.struct(*keep), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in keep])


def first_value_per_key(value: str, order: str) -> Column:
    """Aggregate: the non-NULL value with the smallest order value, ties by the value itself."""
    present = F.col(value).isNotNull()
    return F.min_by(F.when(present, F.col(value)), F.when(present, F.struct(F.col(order), F.col(value))))


def with_previous_period(
    df: DataFrame, keys: Sequence[str], month: str, carry: dict[str, str], sep: str = DASH, how: str = "left", lag: int = 1
) -> DataFrame:
    """Add columns of the row exactly `lag` months earlier with the same key; a gap gives NULL ('inner' drops it).

    `carry` maps a source column to its new name; key and month identify a row. The frame is the single value
    `month - lag` of the month index, so this equals the self-join on the shifted month with one shuffle and one
    scan instead of two of each (a plain lag would step over gaps).
    """
    earlier = (
        Window.partitionBy(*keys).orderBy(month_index(F.col(month), sep)).rangeBetween(-lag, -lag)
    )
    out = df.withColumn("_earlier", F.first(F.struct(*[F.col(c).alias(n) for c, n in carry.items()])).over(earlier))
    if how == "inner":
        out = out.filter(F.col("_earlier").isNotNull())
    return out.select(*df.columns, *[F.col(f"_earlier.{n}").alias(n) for n in carry.values()])


def merge_series(frames: Sequence[DataFrame], on: str, how: str = "left") -> DataFrame:
    """Chain of joins of monthly series on the month."""
    return reduce(lambda a, b: a.join(b, on, how), frames)


def lookup(df: DataFrame, key: str, table: DataFrame, table_key: str, values: Sequence[str]) -> DataFrame:
    """Dictionary lookup: left join on a frame with one row per key, whatever the key column is called."""
    renamed = table.select(F.col(table_key).alias(key), *values)
    return df.join(renamed, key, "left")


def wide_to_long(df: DataFrame, ids: Sequence[str], measures: Sequence[str], name: str, value: str) -> DataFrame:
    """Unpivot without the NULL cells."""
    return df.unpivot(list(ids), list(measures), name, value).filter(F.col(value).isNotNull())


def long_to_wide(
    df: DataFrame, ids: Sequence[str], key: str, labels: dict[str, str], value: str, fill=0
) -> DataFrame:
    """Pivot to a known list of key values (value -> column name), sums, NULL cells filled.

    The list comes from the caller, so Spark runs no extra job to find it. Rows of other key values still make
    their id combination appear, as a pivot does.
    """
    sums = [
        F.coalesce(F.sum(F.when(F.col(key) == k, F.col(value))), F.lit(fill)).alias(n) for k, n in labels.items()
    ]
    return df.groupBy(*ids).agg(*sums)


def top_and_bottom(df: DataFrame, group: str, score: str, tie: str, n: int = 3) -> DataFrame:
    """Best (smallest score) and worst (largest score) n per group, with their rank.

    Both windows are cut by Spark's window group limit before the shuffle, so a large group sends n rows per task.
    """
    best = Window.partitionBy(group).orderBy(F.col(score).asc_nulls_last(), F.col(tie))
    worst = Window.partitionBy(group).orderBy(F.col(score).desc_nulls_last(), F.col(tie))
    scored = df.filter(F.col(score).isNotNull())
    take = lambda window, side: (
        scored.withColumn("rank", F.row_number().over(window))
        .filter(F.col("rank") <= n)
        .withColumn("side", F.lit(side))
    )
    return take(best, "best").unionByName(take(worst, "worst"))


def rows_sharing_no_key(df: DataFrame, key: str, removed: DataFrame) -> DataFrame:
    """Key-set difference: rows whose key is not among the removed keys (a NULL key is kept)."""
    return df.join(removed.select(key), key, "left_anti")
