"""Exact ranks and quantiles without sending a group to one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import cut_lineage

RANGES = 3  # ranges per shuffle partition: the fewer rows a range has, the fewer are put in order


def seeded_hash(key: Column, seed: int) -> Column:
    """Hex digest of seed and key: the same order on every run, cluster size and engine."""
    return F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))


def hash_rank(df: DataFrame, strata: Sequence[str], key: str, seed: int = 42, digits: int = 4) -> DataFrame:
    """Add `_rank` (1..n in seeded-hash order) and `_size` (n) per stratum; `key` must be unique.

    A stratum may hold most of the rows, so it is never one window: the first `digits` hex digits cut it into even
    slices (65,536 for four), slices are counted, and the rank is the running count of earlier slices plus the rank
    inside.
    """
    hashed = df.withColumn("_hash", seeded_hash(F.col(key), seed)).withColumn("_slice", F.substring("_hash", 1, digits))
    keys = list(strata)
    slices = hashed.groupBy(*keys, "_slice").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(
        *[F.col(c).alias(f"_s_{c}") for c in keys],
        F.col("_slice").alias("_s__slice"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias("_size"),
    )
    on = [hashed[c].eqNullSafe(slices[f"_s_{c}"]) for c in [*keys, "_slice"]]
    inside = Window.partitionBy(*keys, "_slice").orderBy("_hash", key)
    joined = hashed.join(slices, on).withColumn("_rank", F.col("_before") + F.row_number().over(inside))
    return joined.select(*df.columns, "_rank", "_size")


def ranged(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`df` written in ranges of `keys` and read back, with `_range`, the file that a row is in; see `range_order`.

    Inside a range rows are in no order.
    """
    count = RANGES * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # stated, so that small ranges are not joined
    files = cut_lineage(df.repartitionByRange(count, *[F.asc(k) for k in keys]))
    return files.withColumn("_range", files.metadataColumn("_metadata")["file_name"])


def range_order(name: str = "_range") -> Column:
    """Orders ranges: whatever comes later has no smaller keys. File names carry the number of the task and of its file."""
    number = lambda pattern: F.regexp_extract(name, pattern, 1).cast("int")
    return F.struct(number(r"^part-(\d+)-"), number(r"-c(\d+)\."))


def level_quantiles(
    df: DataFrame, levels: Mapping[str, Sequence[str]], value: str, probs: Mapping[str, float], level: str = "level"
) -> DataFrame:
    """Exact interpolated quantiles at several group levels (name -> group columns), all from one scan and one ordering.

    One row per level and group: `level`, every group column (NULL where the level does not use it), one column per entry of
    `probs` (name -> p). NULL values and NULL keys are left out. Equal values are counted first, so a hot value costs
    one row. The counted values are cut into ranges of (level, group, value) and written; a group of most rows covers many
    ranges. Running sums of the row counts per (group, range) tell which ranges hold a wanted rank, and only those
    are put in order.
    """
    columns = list(dict.fromkeys(c for group in levels.values() for c in group))
    used = df.select(*columns, F.col(value).cast("double").alias("_v")).filter("_v is not null")
    entries = []
    for number, group in enumerate(levels.values()):
        cells = [(F.col(c) if c in group else F.lit(None).cast(used.schema[c].dataType)).alias(c) for c in columns]
        known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in group], F.lit(True))
        entries.append(F.struct(F.lit(number).alias("_level"), *cells, known.alias("_known")))
    keys = ["_level", *columns]
    rows = used.select(F.inline(F.array(*entries)), "_v").filter("_known")
    counted = rows.groupBy(*keys, "_v").agg(F.count("*").alias("_c"))
    rows = ranged(counted, [*keys, "_v"])

    size = F.sum("_n").over(Window.partitionBy(*keys))
    counts = rows.groupBy(*keys, "_range").agg(F.sum("_c").alias("_n"))
    counts = counts.withColumns({"_size": size, "_from": _before("_n", keys, range_order())})
    place = {n: F.lit(p) * (F.col("_size") - 1) for n, p in probs.items()}
    wanted = F.array_distinct(F.array(*[f(x) for x in place.values() for f in (F.floor, F.ceil)]))
    hit = counts.withColumn("_ranks", _inside(wanted, "_from", "_n")).filter(F.size("_ranks") > 0)
    hit = hit.select(*[F.col(c).alias(f"_h{c}") for c in [*keys, "_range"]], "_size", "_from", "_ranks")
    rows = rows.join(hit, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_h{c}")) for c in [*keys, "_range"]]))

    rows = rows.withColumn("_from", F.col("_from") + _before("_c", [*keys, "_range"], "_v"))
    rows = rows.select(*keys, "_size", "_v", F.explode(_inside(F.col("_ranks"), "_from", "_c")).alias("_rank"))
    found = rows.groupBy(*keys).agg(
        F.max("_size").alias("_size"), F.map_from_entries(F.collect_set(F.struct("_rank", "_v"))).alias("_at")
    )
    out = []
    for name, x in place.items():
        low, high = F.element_at("_at", F.floor(x)), F.element_at("_at", F.ceil(x))
        out.append((low + (high - low) * (x - F.floor(x))).alias(name))
    return found.select(F.get(F.array(*[F.lit(n) for n in levels]), "_level").alias(level), *columns, *out)


def quantiles(df: DataFrame, groups: Sequence[str], value: str, probs: Mapping[str, float]) -> DataFrame:
    """Exact interpolated quantiles per group: one row per group, one column per entry of `probs`; see `level_quantiles`."""
    return level_quantiles(df, {"": groups}, value, probs, "_level").drop("_level")


def _before(count: str, keys: Sequence[str], order: Column | str) -> Column:
    """Running count of the earlier rows."""
    window = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(count).over(window), F.lit(0))


def _inside(ranks: Column, start: str, count: str) -> Column:
    """The ranks that fall on rows start .. start + count - 1."""
    return F.filter(ranks, lambda rank: (rank >= F.col(start)) & (rank < F.col(start) + F.col(count)))
