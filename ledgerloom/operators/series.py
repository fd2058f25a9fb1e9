"""Monthly series: totals, features, lags and moving means.

The windows run over months that are already aggregated: one row per month (and key), a few hundred at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.calendar import calendar_columns
from ledgerloom.functions.periods import month_start, month_text

MONTH = "year_month"


def monthly_totals(txn: DataFrame, date: str, value: str, name: str, keys: Sequence[str] = ()) -> DataFrame:
    return txn.groupBy(*keys, month_text(F.col(date)).alias(MONTH)).agg(F.sum(value).alias(name))


def by_month(keys: Sequence[str] = ()):
    return Window.partitionBy(*keys).orderBy(MONTH)


def with_trend(df: DataFrame, keys: Sequence[str] = (), name: str = "trend") -> DataFrame:
    return df.withColumn(name, F.row_number().over(by_month(keys)))


def with_calendar(df: DataFrame, **options) -> DataFrame:
    """Month number, harmonics and flags from the month string."""
    return df.withColumns(calendar_columns(month_start(F.col(MONTH)), **options))


def with_lags(df: DataFrame, value: str, lags: Sequence[int], name: str, keys: Sequence[str] = ()) -> DataFrame:
    """Value n rows earlier, one column per lag: `name`1, `name`2, ..."""
    return df.withColumns({f"{name}{n}": F.lag(value, n).over(by_month(keys)) for n in lags})


def moving_mean(value: str, first: int, last: int, keys: Sequence[str] = (), full: bool = True) -> Column:
    """Mean of the rows `first`..`last` relative to the current one; NULL until the window is full."""
    window = by_month(keys).rowsBetween(first, last)
    mean = F.avg(value).over(window)
    return F.when(F.count(value).over(window) == last - first + 1, mean) if full else mean


def rolling3(value: str, include_current: bool = False, keys: Sequence[str] = ()) -> Column:
    """Mean of three months: the three before the current one, or the current one and two before."""
    return moving_mean(value, *((-2, 0) if include_current else (-3, -1)), keys)


def trailing12(value: str, keys: Sequence[str] = ()) -> Column:
    """Naive baseline: mean of up to twelve earlier months."""
    return moving_mean(value, -12, -1, keys, full=False)


def split_by_month(df: DataFrame, train_end: str) -> tuple[DataFrame, DataFrame]:
    return df.filter(F.col(MONTH) <= train_end), df.filter(F.col(MONTH) > train_end)


def standardise(df: DataFrame, columns: Sequence[str], suffix: str = "_z", keys: Sequence[str] = ()) -> DataFrame:
    """(x - mean) / population standard deviation; NULL for a constant column.

    Mean and deviation come from one aggregate: a scalar subquery without keys, a join of one row per key with them.
    """
    stats = [F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns]
    if keys:
        found = df.groupBy(*keys).agg(F.struct(*stats).alias("_z"))
        out, box = df.join(found, list(keys)), F.col("_z")
    else:
        out, box = df, df.agg(F.struct(*stats)).scalar()
    scaled = {f"{c}{suffix}": F.try_divide(F.col(c) - box[c]["m"], F.nullif(box[c]["s"], F.lit(0.0))) for c in columns}
    return out.withColumns(scaled).drop("_z") if keys else out.withColumns(scaled)
