"""Session settings shared by jobs, the bench and the tests."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings a job needs for wide joins and skewed keys. Partition counts are left to AQE: it starts from
# `initialPartitionNum` and merges small shuffle blocks towards the advisory size.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, app: str = "ledgerloom", memory: str = "8g") -> SparkSession:
    """Single-JVM session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A new folder name for intermediate files: inside `spark.checkpoint.dir`, the folder every executor sees, or
    inside the folder given to `setCheckpointDir`.

    A temporary folder is used only by a single-machine session that names none.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return f"{shared.rstrip('/')}/run-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` as Parquet to the shared folder and continue from the files.

    Lost executors lose nothing of it, and the optimizer knows its size.
    """
    path = f"{shared_folder(df.sparkSession)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
