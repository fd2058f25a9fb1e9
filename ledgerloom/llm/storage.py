"""Intermediate tables in the folder that the driver and every executor share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under `spark.checkpoint.dir`, else under the folder given to `setCheckpointDir`.

    Only a single-machine session that names neither (a test) gets a temporary folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="llm-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(shared)
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write `df` as Parquet in the shared folder and continue from the files; lost executors lose nothing of it."""
    path = f"{work_folder(df.sparkSession, name)}/table"
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_scan(df: DataFrame) -> DataFrame:
    """`df` if its rows have a place in a file (a plain scan, filtered or not), else a saved copy that has."""
    try:
        df.select(df.metadataColumn("_metadata")["row_index"]).schema  # noqa: B018  resolves the plan
        return df
    except AnalysisException:
        return saved(df, "located")


def located(df: DataFrame, *columns: Column) -> DataFrame:
    """The given columns of a file scan with `_path` and `_row`, the place of each row."""
    at = df.metadataColumn("_metadata")
    return df.select(*columns, at["file_path"].alias("_path"), at["row_index"].alias("_row"))
