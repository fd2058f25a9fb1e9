"""Sinks. Parquet by default; a month is a partition, so a reload replaces one partition and nothing else."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.session import cut_lineage


MANIFEST = "_built_from.json"


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of a location in any store that Spark reaches."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = _hadoop(spark, path)
    return files.exists(target)


def input_files(spark: SparkSession, paths: Sequence[str]) -> list[list]:
    """[path, size, modification time] of every file below the given paths, sorted; a missing path is listed with size -1.

    Markers and hidden files count, too. The listing is made by the driver, three calls a file.
    """
    out = []
    for path in paths:
        files, target = _hadoop(spark, path)
        if not files.exists(target):
            out.append([path, -1, -1])
            continue
        found = files.listFiles(target, True)
        while found.hasNext():
            status = found.next()
            out.append([status.getPath().toString(), status.getLen(), status.getModificationTime()])
    return sorted(out)


def _read_text(spark: SparkSession, path: str) -> str | None:
    files, target = _hadoop(spark, path)
    if not files.exists(target):
        return None
    stream = files.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    files, target = _hadoop(spark, path)
    stream = files.create(target, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def reuse_or_build(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], inputs: Sequence[str] = (), parameters: Mapping | None = None
) -> DataFrame:
    """Read a finished Parquet result that was built from the same files and parameters, else build, write and read it back.

    A manifest beside the result names the files of `inputs` with sizes and times, the parameters (anything that JSON
    holds) and the schema of the result. It is taken before the build and written last: a build that fails leaves none, and
    an input that changes during the build is noticed the next time. Reusing a result starts no job.
    """
    wanted = {"inputs": input_files(spark, inputs), "parameters": json.loads(json.dumps(parameters or {}, sort_keys=True))}
    held = _read_text(spark, f"{path}/{MANIFEST}")
    if held is not None:
        found = json.loads(held)
        if {k: found.get(k) for k in wanted} == wanted:
            return spark.read.schema(StructType.fromJson(found["schema"])).parquet(path)
        files, target = _hadoop(spark, f"{path}/{MANIFEST}")
        files.delete(target, False)
    built = build()
    built.write.mode("overwrite").parquet(path)
    schema = json.loads(built.schema.json())
    _write_text(spark, f"{path}/{MANIFEST}", json.dumps(wanted | {"schema": schema}))
    return spark.read.schema(built.schema).parquet(path)


def write_delimited(df: DataFrame, path: str) -> None:
    """Headered CSV folder, one file per partition."""
    df.write.mode("overwrite").option("header", True).csv(path)


def review_extract(
    df: DataFrame, missing: str, keep: Sequence[str], inputs: Sequence[str] = ()
) -> DataFrame:
    """Rows without a label, some columns of them, plus blank columns to be filled in by hand."""
    return df.filter(F.col(missing).isNull()).select(*keep, *[F.lit("").alias(c) for c in inputs])


def replace_months(df: DataFrame, path: str, month: str = "mo") -> None:
    """Idempotent reload: only the months present in `df` are replaced.

    The rows are clustered by month before the write; AQE splits a month that is too large for one task.
    """
    clustered = df.hint("rebalance", F.col(month))
    clustered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(month).parquet(path)


def append_dated(df: DataFrame, path: str, date: str = "date_balance") -> None:
    df.hint("rebalance", F.col(date)).write.mode("append").partitionBy(date).parquet(path)


def update_matched(
    target: DataFrame,
    matches: DataFrame,
    keys: Sequence[str],
    updates: Mapping[str, Column | str],
    when: Column | None = None,
) -> DataFrame:
    """Target rows whose key occurs in `matches` (and that satisfy `when`) get new values.

    `matches` is reduced to distinct keys, so no row is multiplied. An update given as text names a column of
    `matches`, whose largest value per key is taken; any other update is an expression over the target.
    """
    carried = {c: v for c, v in updates.items() if isinstance(v, str)}
    if carried:
        grouped = matches.groupBy(*keys).agg(
            F.lit(True).alias("_hit"), *[F.max(v).alias(f"_new_{c}") for c, v in carried.items()]
        )
    else:
        grouped = matches.select(*keys).distinct().withColumn("_hit", F.lit(True))
    joined = target.join(grouped, list(keys), "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    if when is not None:
        hit = hit & F.coalesce(when, F.lit(False))
    out = []
    for c in target.columns:
        if c in updates:
            value = F.col(f"_new_{c}") if c in carried else updates[c]
            out.append(F.when(hit, value).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)


def rewrite_months(
    target: DataFrame, touched: DataFrame, change: Callable[[DataFrame], DataFrame], swap: Callable[[DataFrame], None], month: str = "mo"
) -> list:
    """Rewrite the months that occur in `touched`, and no others, of a stored table; returns them in order.

    `target` reads the stored table, `change` maps the rows of these months to their new rows, `swap` replaces months of the store
    (`replace_months`, `history.reload_months`). The new rows are written elsewhere first, so nothing is read from what is being
    overwritten, and a failure before the swap leaves the old months.
    """
    months = sorted((r[0] for r in touched.select(month).distinct().collect()), key=lambda m: (m is not None, m))  # a row per month
    if not months:
        return []
    chosen = reduce(lambda a, b: a | b, [F.col(month).eqNullSafe(F.lit(m)) for m in months])
    swap(cut_lineage(change(target.filter(chosen)).select(*target.columns)))
    return months


def update_stored(
    target: DataFrame,
    matches: DataFrame,
    keys: Sequence[str],
    updates: Mapping[str, Column | str],
    swap: Callable[[DataFrame], None],
    when: Column | None = None,
    month: str = "mo",
) -> list:
    """`update_matched` on a stored table: only months with a matching row are rewritten; returns them.

    A semi-join that reads keys, month and the columns of `when` finds the months. A row that matches but would keep its
    values still counts as matching.
    """
    hit = target.join(matches.select(*keys).distinct(), list(keys), "left_semi")
    if when is not None:
        hit = hit.filter(when)
    return rewrite_months(target, hit, lambda rows: update_matched(rows, matches, keys, updates, when), swap, month)
