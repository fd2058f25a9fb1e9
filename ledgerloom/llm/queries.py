"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    bit_scatter,
    chunk_prints,
    exact_dedup,
    kmeans_tree,
    merkle,
    mixing,
    order_minhash,
    pieces,
    pseudonyms,
    substring_dedup,
    token_files,
    toxicity,
    warc,
)
from ledgerloom.llm.storage import work_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of a session and a table folder."""

    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return wrap


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query(
    "op10_exact_dedup",
    """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
)
def exact_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    groups = exact_dedup.duplicate_groups(table(spark, folder, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


@query("op2_substring_dedup")
def repeated_windows(spark: SparkSession, folder: str) -> DataFrame:
    kept = substring_dedup.removed_words(table(spark, folder, "documents"))
    return kept.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


@query(
    "op4_warc_archive",
    """
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
           CASE WHEN octet_length(encode(coalesce(html, ''))) >= 1000 AND page_id < max(page_id) OVER same
                THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN octet_length(encode(coalesce(html, ''))) >= 1000 AND page_id < max(page_id) OVER same
                THEN max(page_id) OVER same END AS refers_to
    FROM pages WINDOW same AS (PARTITION BY coalesce(html, ''))
    """,
)
def warc_archive(spark: SparkSession, folder: str) -> DataFrame:
    archive = work_folder(spark, "warc")
    warc.write_archive(table(spark, folder, "pages"), archive)
    return warc.describe(warc.read_records(spark, archive)).drop("url")


@query("op7_token_files")
def token_ids(spark: SparkSession, folder: str) -> DataFrame:
    files = work_folder(spark, "token-files")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    token_files.write_token_files(table(spark, folder, "documents"), files, tokenizer)
    read = token_files.read_token_files(spark, files, with_ids=False)
    return read.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


@query("op5_near_duplicates")
def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    classes = order_minhash.near_duplicate_classes(table(spark, folder, "documents"))
    return classes.select(F.col("id").alias("doc_id"), "class_id", "class_size", "verified_links", "kept")


@query("op3_toxicity")
def toxicity_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, folder, "labels")))
    predicted = (F.col("score") >= toxicity.LIMIT).cast("int")
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", predicted.alias("predicted"))


@query("op8_nearest_vectors")
def nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return kmeans_tree.search(table(spark, folder, "embeddings"))


@query("op9_piece_ids")
def piece_ids(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = pieces.round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", F.size("piece_ids").cast("bigint").alias("n_pieces"), "piece_ids", "round_trip")


@query("op1_pseudonyms")
def personal_values(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymise(docs, key=b"a demonstration key; use a secret one")


@query("op6_pfair_mix")
def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.slotted(table(spark, folder, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "source", "block", "slot", "place", "on_target")


# crc32 of a decimal id in SQL: eight shifts per byte with the reflected polynomial 0xEDB88320
CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda r, b: list_reduce([xor(r, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""


def field(column: str) -> str:
    return f"coalesce(octet_length(encode({column}::VARCHAR))::VARCHAR || ':' || {column}::VARCHAR, '-')"


@query(
    "op12_merkle_manifest",
    f"""
    WITH RECURSIVE rows AS (
      SELECT doc_id, coalesce('=' || lang, '-') AS grp, {field('doc_id')} || {field('source')} || {field('lang')} AS head, n_chars,
             {field('text')} AS tail, {CRC} % 7 = 0 AS hit FROM documents),
    leaves AS (
      SELECT doc_id, grp, sha256(head || {field('n_chars')} || tail) AS leaf,
             CASE WHEN hit THEN sha256(head || {field('(n_chars + 1)')} || tail) ELSE sha256(head || {field('n_chars')} || tail) END AS got FROM rows),
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY grp) AS n FROM leaves),
    tree(grp, level, place, node, n) AS (
      SELECT grp, 0, place, leaf, n FROM placed
      UNION ALL
      SELECT grp, level + 1, place // 2, sha256(string_agg(node, '' ORDER BY place)), (n + 1) // 2 FROM tree WHERE n > 1
      GROUP BY grp, level + 1, place // 2, (n + 1) // 2),
    ends AS (
      SELECT grp, level AS height, node AS subroot, row_number() OVER (ORDER BY grp) - 1 AS place, count(*) OVER () AS n FROM tree WHERE n = 1),
    top(level, place, node, n) AS (
      SELECT 0, place, subroot, n FROM ends
      UNION ALL
      SELECT level + 1, place // 2, sha256(string_agg(node, '' ORDER BY place)), (n + 1) // 2 FROM top WHERE n > 1
      GROUP BY level + 1, place // 2, (n + 1) // 2),
    depth AS (SELECT level AS height, node AS root FROM top WHERE n = 1),
    steps AS (
      SELECT p.grp, p.place, s.level, (p.place >> s.level) % 2 AS side, coalesce(t.node, '') AS sibling
      FROM placed p JOIN ends e USING (grp) JOIN (SELECT DISTINCT level FROM tree) s ON s.level < e.height
      LEFT JOIN tree t ON t.grp = p.grp AND t.level = s.level AND t.place = xor(p.place >> s.level, 1)
      UNION ALL
      SELECT p.grp, p.place, e.height + s.level, (e.place >> s.level) % 2, coalesce(t.node, '')
      FROM placed p JOIN ends e USING (grp) CROSS JOIN depth d JOIN (SELECT DISTINCT level FROM top) s ON s.level < d.height
      LEFT JOIN top t ON t.level = s.level AND t.place = xor(e.place >> s.level, 1)),
    folded(grp, place, level, node) AS (
      SELECT grp, place, 0, got FROM placed
      UNION ALL
      SELECT f.grp, f.place, f.level + 1, sha256(CASE WHEN s.side = 1 THEN s.sibling || f.node ELSE f.node || s.sibling END)
      FROM folded f JOIN steps s ON s.grp = f.grp AND s.place = f.place AND s.level = f.level),
    proofs AS (SELECT grp, place, sha256(string_agg(sibling, '' ORDER BY level)) AS proof_sha256 FROM steps GROUP BY 1, 2)
    SELECT p.doc_id, p.leaf, e.subroot, d.root, coalesce(r.proof_sha256, sha256('')) AS proof_sha256, f.node AS folded_root, f.node = d.root AS verified
    FROM placed p JOIN ends e USING (grp) CROSS JOIN depth d JOIN folded f ON f.grp = p.grp AND f.place = p.place AND f.level = e.height + d.height
    LEFT JOIN proofs r ON r.grp = p.grp AND r.place = p.place
    """,
)
def merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    rows = merkle.audit(
        table(spark, folder, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id",
        received={"n_chars": F.col("n_chars") + 1}, changed=tampered,
    )
    return rows.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", "verified"
    )


@query("op13_chunk_prints")
def chunk_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return chunk_prints.compare_with_next(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


@query("op11_whitening")
def whitened_vectors(spark: SparkSession, folder: str) -> DataFrame:
    found = bit_scatter.whiten(table(spark, folder, "embeddings"))
    deviation = F.expr("try_cast(deviation as bigint)").alias("deviation")
    return found.select(F.col("id").alias("vec_id"), "component", "n", deviation, "whitened", "explained", "identity_error")
