"""Monthly history stored in buckets: partitioned by month, inside a month one file per hash bucket of the contract key.

Tables with the same key and number of buckets are joined on that key without moving a row, month against month
included, and a reload of some months keeps the layout. The bucket number is part of the table's definition, so a bucket
should fit an executor at the size the largest month will reach.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str, month: str | None = None) -> DataFrame:
    """Create the external table at `path` and return it; rows are moved once, so a bucket is one file."""
    writer = df.repartition(buckets, F.col(key)).write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path)
    if month is not None:
        writer = writer.partitionBy(month)
    writer.mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)


def attach_bucketed(
    spark: SparkSession, table: str, schema: str, key: str, buckets: int, path: str, month: str | None = None
) -> DataFrame:
    """Make a table written by `write_bucketed` known to another session. `schema` is DDL text, the month column last."""
    parts = f"PARTITIONED BY ({month})" if month is not None else ""
    spark.sql(
        f"CREATE TABLE {table} ({schema}) USING parquet {parts} CLUSTERED BY ({key}) SORTED BY ({key}) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )
    if month is not None:
        spark.catalog.recoverPartitions(table)
    return spark.table(table)


def reload_months(df: DataFrame, table: str, key: str, buckets: int) -> DataFrame:
    """Replace the months that occur in `df` and no others; buckets stay one file each. Returns the table.

    Columns are matched by name. `df` must not read the months that it replaces.
    """
    spark = df.sparkSession
    rows = df.select(*spark.table(table).columns).repartition(buckets, F.col(key))
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        rows.write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(mode, before)
    spark.catalog.refreshTable(table)
    return spark.table(table)


def shuffles(df: DataFrame) -> Sequence[str]:
    """Lines of the physical plan that move rows by key; broadcasts of small sides do not count."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.strip(" :+-*") for line in plan.splitlines() if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line]
