"""Corpus preparation: toxicity, exact and near duplicates, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet in the shared folder and
reread as the next one's docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import exact_dedup, mixing, order_minhash, pieces, toxicity
from ledgerloom.llm.storage import file_scan, located, saved


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a positive-unlabelled model, trained here on the table's labels, scores 0.3 or more go."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by an alignment of 0.8 or more the row with the smallest doc_id stays."""
    return order_minhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix: file after file and row after row."""
    return mixing.mix(docs)


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the file and row that hold its place in the mix."""
    placed = located(file_scan(docs), "doc_id", "source", "text")
    file = F.element_at(F.split("_path", "/"), -1)
    placed = placed.select("doc_id", "source", file.alias("mix_file"), F.col("_row").alias("mix_row"), "text")
    coded = pieces.encode(placed, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.drop("text").withColumn("n_pieces", F.size("piece_ids").cast("bigint"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mix", mix_sources),
    ("piece_ids", piece_ids),
]
ORACLE_SQL = None  # a trained classifier and an alignment have no SQL; tests/llm/test_pipeline.py compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
