"""Exact duplicates with a keyed stream: each digest seen so far is one row of disk-backed state.

The rows of the input are read as a stream of (digest, id, place) in several micro-batches. The state store keeps for each
digest the largest id, the place of that row's text (file and row number) and the number of rows, in RocksDB with
changelogs in the shared folder, and never expires a key: a copy is found however late it comes, and a restarted
stream goes on from the last committed batch. Texts are never in the state. Digests that hit are then checked on
the full bytes of all their texts; should two texts share a digest, they are told apart by the texts themselves.

Defined cases: a null text equals the empty text; a null id is smaller than any other; of repeated rows with one id
and one text exactly one stays; an empty table gives an empty result; other columns are neither read nor changed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.storage import file_scan, located, saved, work_folder

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # many small stores: no preallocated files
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def keyed_rows(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    """The digest, id, text and place of every row of a file scan."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return located(docs, digest(text).alias("digest"), F.col(f"`{id_col}`").alias("id"), text.alias("text"))


def digest_state(keys: DataFrame, path: str, batches: int = 4) -> DataFrame:
    """Stream the table `keys` saved at `path` through keyed state; one row per digest: keep_id, place of that row, rows.

    `batches` is the number of micro-batches that the files are spread over; it changes no result.
    """
    spark: SparkSession = keys.sparkSession
    files = max(1, -(-len(keys.inputFiles()) // batches))
    checkpoint = work_folder(spark, "digest-stream")
    stream = (
        spark.readStream.schema(keys.schema).option("maxFilesPerTrigger", files).parquet(path)
        .groupBy("digest")
        .agg(F.max(F.struct("id", "_path", "_row")).alias("last"), F.count(F.lit(1)).alias("rows"))
    )
    before = {k: spark.conf.get(k, None) for k in STREAM_CONF}
    for k, v in STREAM_CONF.items():
        spark.conf.set(k, v)
    try:
        query = (
            stream.writeStream.format("noop").outputMode("update")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    state = spark.read.format("statestore").load(checkpoint)
    return state.select("key.*", "value.*").toDF("digest", "last", "rows")


def clashing(rows: DataFrame, joined: DataFrame) -> DataFrame:
    """Digests of several rows whose full bytes differ.

    The texts of hits are found by their place, so copies of one text stay spread over the tasks and meet only after each
    task has reduced its own to the smallest and the largest.
    """
    hits = joined.filter("rows > 1").select("digest", "_path", "_row")
    texts = rows.select("text", "_path", "_row").join(hits, ["_path", "_row"])
    ends = texts.groupBy("digest").agg(F.min("text").alias("a"), F.max("text").alias("b"))
    return ends.filter("a <> b").select("digest")


def duplicate_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    batches: int = 4,
) -> DataFrame:
    """One row per row of `docs`: id, digest, keep_id (largest id of the equal texts), group_size, kept, and its place."""
    rows = keyed_rows(file_scan(docs), id_col, text_col, digest)
    folder = f"{work_folder(docs.sparkSession, 'digests')}/table"
    rows.drop("text").write.parquet(folder)
    keys = docs.sparkSession.read.schema(rows.drop("text").schema).parquet(folder)
    state = saved(digest_state(keys, folder, batches), "digest-state")
    joined = saved(keys.join(state, "digest"), "digest-groups")
    clashes = saved(clashing(rows, joined), "clashes")
    if not clashes.isEmpty():  # two texts with one digest: those groups are formed again, by the texts
        shared = rows.join(clashes, "digest", "left_semi")
        groups = shared.groupBy("digest", "text").agg(
            F.max(F.struct("id", "_path", "_row")).alias("last"), F.count(F.lit(1)).alias("rows")
        )
        alone = joined.join(clashes, "digest", "left_anti")
        joined = alone.unionByName(shared.join(groups, ["digest", "text"]).drop("text"))
    same = (F.col("last._path") == F.col("_path")) & (F.col("last._row") == F.col("_row"))
    return joined.select(
        "id", "digest", F.col("last.id").alias("keep_id"), F.col("rows").alias("group_size"), same.alias("kept"), "_path", "_row"
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay: of equal texts the one with the largest id."""
    docs = file_scan(docs)
    stay = duplicate_groups(docs, id_col, text_col).filter("kept").select("_path", "_row")
    return located(docs, F.struct("*").alias("doc")).join(stay, ["_path", "_row"], "left_semi").select("doc.*")
