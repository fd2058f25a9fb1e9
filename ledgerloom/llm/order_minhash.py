"""Near duplicates by Order MinHash and banded alignment.

A text is the sequence of its runs of five words, each labelled with how often it has occurred before. For each of
`functions` hash functions the two smallest labelled runs are kept in the order in which they stand in the text; two
texts agree on such a sample when they share both runs in the same order, which follows edit similarity rather than the
bare set of runs. `rows` samples make a band, and texts that agree on a band are candidates. Candidates are aligned: the
longest common subsequence of their runs, searched in the diagonal band that the threshold leaves, over the number of runs
in either. From 0.8 on the texts are linked, and linked texts form a class.

With the defaults a pair at 0.8 is a candidate with probability 0.998 (two runs in order: 0.8^2; three samples: 0.26; 20
bands), a pair at 0.3 with 0.015.

A bucket may hold a large share of all texts, so it is never paired out. Copies are reduced to one text first. Each bucket
names its most central text (the one whose buckets are largest) as leader, and members are aligned with it. Members that do
not reach it may still be close to others: for those, every pair with enough runs in common is found exactly, by an
inverted index over the rarest runs of each text (two sets with similarity s share one of the n - ceil(s n) + 1 rarest of
each), then aligned. Rare runs are what sets such texts apart, so this index has short lists where buckets are long.

Defined cases: null texts have no words; texts without words are copies of each other; a text of one to four words is one
run; rows with equal words are copies, whatever the white space; repeated ids are rows of their own; a null id is larger
than any other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.graph import components
from ledgerloom.llm.storage import file_scan, located, saved
from ledgerloom.llm.words import Words, spans, mix

SHINGLE = 5
THRESHOLD = 0.8
FUNCTIONS, ROWS = 60, 3
CHUNK_BYTES = 1 << 19
_MULTIPLIERS = np.random.Generator(np.random.PCG64(5)).integers(1, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_NONE = np.uint64(2**64 - 1)


def runs(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word runs of all texts, end to end, and the number of runs before each text."""
    n = np.diff(words.first)
    count = np.where(n >= size, n - size + 1, (n > 0).astype(n.dtype))
    first = np.concatenate([[0], np.cumsum(count)])
    start = np.arange(first[-1]) - np.repeat(first[:-1], count) + np.repeat(words.first[:-1], count)
    end = np.minimum(start + size, np.repeat(words.first[1:], count))
    return (spans(words.hashes, start, end, 1) if len(start) else np.zeros(0, np.uint64)), first


def labelled(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hashes that also count the earlier occurrences of the same run in the same text; distinct inside a text."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((np.arange(len(hashes)), hashes, owner))
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    at = np.arange(len(hashes))
    begin = np.maximum.accumulate(np.where(same, 0, at)) if len(at) else at
    seen = np.empty(len(hashes), np.uint64)
    seen[order] = (at - begin).astype(np.uint64)
    return mix(hashes + seen * np.uint64(0x9E3779B97F4A7C15))


def bands(values: np.ndarray, first: np.ndarray, functions: int = FUNCTIONS, rows: int = ROWS) -> np.ndarray:
    """Band keys (texts x bands) of texts that have at least one run."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    starts, texts = first[:-1], len(first) - 1
    samples = np.empty((functions, texts), np.uint64)
    for k in range(functions):
        ranked = values * _MULTIPLIERS[k]  # a bijection, so minima are met once in each text
        at = np.flatnonzero(ranked == np.minimum.reduceat(ranked, starts)[owner])
        ranked[at] = _NONE
        second = np.minimum.reduceat(ranked, starts)
        other = at.copy()
        hit = np.flatnonzero((ranked == second[owner]) & (ranked != _NONE))
        other[owner[hit]] = hit
        early, late = values[np.minimum(at, other)], values[np.maximum(at, other)]
        samples[k] = mix(early * np.uint64(3) + mix(late))
    keys = np.empty((texts, functions // rows), np.uint64)
    for j in range(functions // rows):
        key = np.full(texts, j + 1, np.uint64)
        for k in range(j * rows, (j + 1) * rows):
            key = mix(key * np.uint64(31) + samples[k])
        keys[:, j] = key
    return keys


def aligned(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """Share of common runs in an alignment of two run sequences, 0.0 when it stays below the threshold.

    The alignment may leave out at most (|a| + |b|) (1 - t) / (1 + t) runs, so it lies within that many diagonals of the
    main one. The band slides along `b`; its bits are the columns of the dynamic programme, a zero where the row above
    grows by one.
    """
    total = len(a) + len(b)
    if not total or min(len(a), len(b)) < threshold * max(len(a), len(b)):
        return 0.0
    slack = int(total * (1 - threshold) / (1 + threshold) + 1e-9)
    least = min(len(a), len(b))
    differs = np.flatnonzero(a[:least] != b[:least])
    head = int(differs[0]) if len(differs) else least
    differs = np.flatnonzero(a[len(a) - least + head :][::-1] != b[len(b) - least + head :][::-1])
    tail = int(differs[0]) if len(differs) else least - head
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    common = head + tail
    if len(a) and len(b):
        places: dict[int, list[int]] = {}
        for i, x in enumerate(a.tolist()):
            places.setdefault(x, []).append(i)
        width = 2 * slack + 1
        full = (1 << width) - 1
        live, passed, base = full, 0, -slack
        for y in b.tolist():
            found = 0
            for i in places.get(y, ()):
                if 0 <= i - base < width:
                    found |= 1 << (i - base)
            if found:
                both = live & found
                live = ((live + both) | (live - both)) & full
            passed += 1 - (live & 1)
            live = (live >> 1) | (1 << (width - 1))
            base += 1
        common += passed + (width - live.bit_count())
    share = common / (total - common)
    return share if share >= threshold - 1e-12 else 0.0


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common labelled runs of two texts, an upper bound of every alignment."""
    return len(np.intersect1d(a, b, assume_unique=True))


def chunks(column: pa.Array, size: int = CHUNK_BYTES):
    """Start and end rows of pieces with about `size` bytes of text."""
    lengths = np.array([len(x.as_buffer()) if x.is_valid else 0 for x in column])
    ends = np.flatnonzero(np.diff(np.cumsum(lengths) // size, prepend=0)) + 1
    edges = np.unique(np.concatenate([[0], ends, [len(lengths)]]))
    return list(zip(edges[:-1].tolist(), edges[1:].tolist()))


def signatures(docs: DataFrame, id_col: str, text_col: str, size: int, functions: int, rows: int) -> DataFrame:
    """Per row of a file scan: id, place, digest of its words and band keys (none without words)."""

    def sign(batches):
        for batch in batches:
            for low, high in chunks(batch.column("text")):
                part = batch.slice(low, high - low)
                words = Words(part.column("text"))
                hashes, first = runs(words, size)
                some = np.flatnonzero(np.diff(first))
                keys = [[] for _ in range(len(first) - 1)]
                if len(some):
                    filled = np.concatenate([first[some], first[-1:]])
                    for i, row in zip(some.tolist(), bands(labelled(hashes, filled), filled, functions, rows).view(np.int64)):
                        keys[i] = row
                digests = [hashlib.sha256(b" ".join(words.text(i).split())).digest()[:16] for i in range(len(keys))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("_path"), part.column("_row"), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    names=["id", "_path", "_row", "digest", "bands"],
                )

    ident = F.col(f"`{id_col}`").cast("bigint").alias("id")
    source = located(docs, ident, F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    return source.mapInArrow(sign, "id bigint, _path string, _row bigint, digest binary, bands array<bigint>")


def verify(pairs: DataFrame, texts: DataFrame, size: int, threshold: float) -> DataFrame:
    """Pairs (a, b) of nodes whose texts align, with the similarity. `texts`: (node, text)."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def check(batches):
        for batch in batches:
            out = []
            for low, high in chunks(batch.column("text_a")):
                part = batch.slice(low, high - low)
                sides = []
                for name in ("text_a", "text_b"):
                    hashes, first = runs(Words(part.column(name)), size)
                    sides.append((hashes, labelled(hashes, first), first))
                (ha, la, fa), (hb, lb, fb) = sides
                for i in range(high - low):
                    a, b = slice(fa[i], fa[i + 1]), slice(fb[i], fb[i + 1])
                    total = (a.stop - a.start) + (b.stop - b.start)
                    shared = overlap(la[a], lb[b])
                    share = aligned(ha[a], hb[b], threshold) if shared >= threshold * (total - shared) - 1e-9 else 0.0
                    if share:
                        out.append((part.column("a")[i].as_py(), part.column("b")[i].as_py(), share))
            a, b, s = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s, pa.float64())], names=["a", "b", "similarity"])

    joined = pairs.select("a", "b").join(left, "a").join(right, "b")
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(check, "a bigint, b bigint, similarity double")


def leader_pairs(live: DataFrame) -> DataFrame:
    """(a, b): each node with the leader of each of its buckets. `live`: (key, node, n) of buckets with several nodes."""
    weight = live.groupBy("node").agg(F.sum("n").alias("weight"))
    best = F.max(F.struct("weight", (-F.col("node")).alias("back"))).alias("best")
    leaders = live.select("key", "node").join(weight, "node").groupBy("key").agg(best)
    leaders = saved(leaders.select("key", (-F.col("best.back")).alias("leader")), "leaders")
    pairs = live.select("key", "node").join(leaders, "key").filter("node <> leader")
    return pairs.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()


def open_nodes(live: DataFrame, roots: DataFrame) -> DataFrame:
    """Nodes (with their root) of buckets whose nodes are not all in one component yet."""
    placed = live.select("key", "node").join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    several = placed.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y").select("key")
    return placed.join(several, "key").select("node", "root").distinct()


def rare_run_pairs(nodes: DataFrame, texts: DataFrame, size: int, threshold: float) -> DataFrame:
    """All pairs of nodes of different components that can reach the threshold, by the rarest runs of each."""

    def emit(batches):
        for batch in batches:
            for low, high in chunks(batch.column("text"), CHUNK_BYTES // 2):
                part = batch.slice(low, high - low)
                hashes, first = runs(Words(part.column("text")), size)
                n = np.diff(first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(part.column("node").to_numpy(), n)),
                        pa.array(np.repeat(part.column("root").to_numpy(), n)),
                        pa.array(np.repeat(n, n).astype(np.int32)),
                        pa.array(labelled(hashes, first).view(np.int64)),
                    ],
                    names=["node", "root", "n", "run"],
                )

    rows = texts.join(nodes, "node").select("node", "root", "text")
    rows = rows.mapInArrow(emit, "node bigint, root bigint, n int, run bigint")
    rows = saved(rows, "runs")
    often = rows.groupBy("run").agg(F.count(F.lit(1)).alias("often"))
    rank = F.row_number().over(Window.partitionBy("node").orderBy("often", "run"))
    need = F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1
    first = rows.join(often, "run").withColumn("rank", rank).filter((F.col("rank") <= need) & (F.col("often") > 1))
    first = saved(first.select("node", "root", "n", "run", "rank"), "rare-runs")
    # In each list the component with most entries is one side only: its members are not paired with each other.
    share = first.groupBy("run", "root").agg(F.count(F.lit(1)).alias("entries"))
    major = share.groupBy("run").agg(F.max_by("root", "entries").alias("major"), F.count(F.lit(1)).alias("roots"))
    minor = saved(first.join(major.filter("roots > 1"), "run").filter("root <> major").drop("major", "roots"), "minor-runs")
    # At the first run that two texts share, at most the runs behind it in either can follow; that has to be enough.
    follow = 1 + F.least(F.col("n") - F.col("rank"), F.col("n_b") - F.col("rank_b"))
    enough = follow >= (F.col("n") + F.col("n_b")) * (threshold / (1 + threshold)) - 1e-9
    pairs = minor.join(first.toDF("node_b", "root_b", "n_b", "run", "rank_b"), "run").filter("root <> root_b").filter(enough)
    return pairs.select(F.least("node", "node_b").alias("a"), F.greatest("node", "node_b").alias("b")).distinct()


def near_duplicate_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    size: int = SHINGLE,
    functions: int = FUNCTIONS,
    rows: int = ROWS,
) -> DataFrame:
    """Per row: id, class_id (smallest id of its class), class_size (rows), verified_links (of its text), kept, and its place.

    `verified_links` counts the pairs with this text that were aligned and linked: those with bucket leaders and those found by
    rare runs. It is no degree: members of one class are not all compared, so in a large class it is far below the number of
    near copies.
    `kept` marks one row of each class, the one with the smallest id.
    """
    docs = file_scan(docs)
    signed = saved(signatures(docs, id_col, text_col, size, functions, rows), "signatures")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "_path", "_row")
    one = signed.groupBy("digest").agg(F.min(place).alias("place"), F.first("bands").alias("bands"))
    one = saved(one.withColumn("node", F.monotonically_increasing_id()), "distinct-texts")

    exploded = saved(one.select("node", F.explode("bands").alias("key")), "bands")
    sizes = saved(exploded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "buckets")
    live = saved(exploded.join(sizes, "key"), "live-bands")

    wanted = live.select("node").distinct().join(one.select("node", "place._path", "place._row"), "node")
    texts = located(docs, F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    texts = saved(texts.join(wanted, ["_path", "_row"]).select("node", "text"), "candidate-texts")

    links = saved(verify(saved(leader_pairs(live), "pairs"), texts, size, threshold), "verified")
    roots = components(links)
    rest = saved(open_nodes(live, roots.withColumnRenamed("id", "node")), "open")
    more = saved(verify(saved(rare_run_pairs(rest, texts, size, threshold), "pairs"), texts, size, threshold), "verified")
    links = links.union(more)
    roots = components(links)

    degree = links.select("a").union(links.select("b")).groupBy("a").agg(F.count(F.lit(1)).alias("verified_links")).withColumnRenamed("a", "node")
    named = one.select("digest", "node").join(roots.withColumnRenamed("id", "node"), "node", "left").join(degree, "node", "left")
    named = saved(named.select("digest", F.coalesce("root", "node").alias("root"), F.coalesce("verified_links", F.lit(0)).alias("verified_links")), "classes")
    members = saved(signed.select("id", "_path", "_row", "digest").join(named, "digest"), "members")
    heads = saved(members.groupBy("root").agg(F.min(place).alias("head"), F.count(F.lit(1)).alias("class_size")), "heads")
    kept = (F.col("head._path") == F.col("_path")) & (F.col("head._row") == F.col("_row"))
    return members.join(heads, "root").select(
        "id", F.col("head.id").alias("class_id"), "class_size", "verified_links", kept.alias("kept"), "_path", "_row"
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs` that stay: one of each class."""
    docs = file_scan(docs)
    stay = near_duplicate_classes(docs, id_col, text_col, **options).filter("kept").select("_path", "_row")
    return located(docs, F.struct("*").alias("doc")).join(stay, ["_path", "_row"], "left_semi").select("doc.*")
