"""Repeated word windows across documents, found through difference-cover anchors.

Positions of a document are taken modulo a period v; an anchor is a run of `window - v + 1` words that starts at a
position whose remainder lies in a difference cover D of v. For any two positions i and j there is a shift below v that
puts both on D, so two equal windows always share an anchor at the same shift: hashing |D| of v positions (4 of 13 for
20 words) misses no match. Anchors that occur once are dropped; only windows around the others are extended to their
full length, hashed to 128 bits and ordered by their first occurrence.

Documents are dealt into groups of about a megabyte by a hash of the id. A group sends each anchor or window
once, however often it holds it, as part of a sorted array per hash range, and gets back one bit for each. So a passage that
every document has is a few bytes per group, no key gathers documents, and both round trips are short arrays. The texts
are shuffled once and that exchange is read three times.

Defined cases: a null text has no words; repeated rows of one id are documents in text order; a null id comes before
all others; a document shorter than a window keeps all words; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.words import Words

# Perfect difference sets: every remainder is a difference of two members (fixed values).
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}

GROUP_BYTES = 1 << 20  # text in one group of documents
RANGE_BYTES = 32 << 20  # text whose anchors make up one hash range
NO_ID = np.iinfo(np.int64).min


def cover_for(window: int) -> tuple[int, tuple[int, ...], int]:
    """Period, cover and anchor length for a window: the largest period that leaves a third of the window to the anchor."""
    v = max(p for p in COVERS if p == 1 or 3 * p <= 2 * (window + 1))
    return v, COVERS[v], window - v + 1


def ordered(table: pa.Table) -> pa.Table:
    """The documents of a group in the order that "earlier" means: id (null first), then text."""
    keys = [("id", "ascending"), ("text", "ascending")]
    return table.take(pc.sort_indices(table, sort_keys=keys, null_placement="at_start")) if table.num_rows > 1 else table


def ids_of(table: pa.Table) -> np.ndarray:
    return table["id"].fill_null(int(NO_ID)).to_numpy()


def texts_of(table: pa.Table) -> pa.Array:
    column = table["text"].combine_chunks()
    return column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)


def cut(sorted_hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Bounds of the hash ranges in a sorted array."""
    edges = np.array([(i << 64) // ranges for i in range(1, ranges)], np.uint64)
    return np.concatenate([[0], np.searchsorted(sorted_hashes, edges), [len(sorted_hashes)]])


def anchors(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Word positions of the anchors and their hashes."""
    period, cover, length = cover_for(window)
    long = np.repeat(np.diff(words.first) >= window, np.diff(words.first))
    at = np.flatnonzero(np.isin(words.place() % period, cover) & words.fits(length) & long)
    return at, words.windows(length, 1)[at]


def candidates(words: Words, window: int, flags: np.ndarray) -> np.ndarray:
    """Starts of the windows that hold a repeated anchor. `flags`: for each distinct anchor, in order, whether other groups have it."""
    period, _, _ = cover_for(window)
    at, hashes = anchors(words, window)
    _, back, count = np.unique(hashes, return_inverse=True, return_counts=True)
    hit = np.zeros(len(words.hashes) + period, np.int64)
    hit[at[(flags | (count > 1))[back]]] = 1
    ahead = np.concatenate([[0], np.cumsum(hit)])
    n = len(words.hashes)
    return np.flatnonzero((ahead[period : period + n] > ahead[:n]) & words.fits(window))


def distinct_windows(words: Words, window: int, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct candidate windows in hash order: both hashes, first start, and for each start the number of its window."""
    a, b = words.windows(window, 1)[starts], words.windows(window, 2)[starts]
    order = np.lexsort((starts, b, a))
    a, b = a[order], b[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return a[new], b[new], starts[order][new], number


def joined_bits(table: pa.Table, count: int) -> np.ndarray:
    """The returned bits of all hash ranges of a group, in hash order."""
    rows = sorted(zip(table["range"].to_pylist(), table["n"].to_pylist(), table["bits"].to_pylist()), key=lambda r: r[0])
    parts = [np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool) for _, n, bits in rows]
    flags = np.concatenate(parts) if parts else np.zeros(0, bool)
    if len(flags) != count:
        raise ValueError(f"{len(flags)} bits came back for {count} hashes")
    return flags


def _split(bits: np.ndarray, table: pa.Table, sizes: list[int]) -> pa.Table:
    ends = np.cumsum([0, *sizes])
    packed = [np.packbits(bits[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:])]
    return pa.table(
        {"grp": table["grp"], "range": table["range"], "n": pa.array(sizes, pa.int32()), "bits": pa.array(packed, pa.binary())}
    )


def removed_words(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 20,
    group_bytes: int = GROUP_BYTES,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Per document: id, n_words, n_removed, kept_text and kept_sha256 of the words that are left.

    A word goes when some window of `window` words over it also starts earlier. Group and range sizes change memory
    and the number of tasks, never the result.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text)).alias("b")).first()["b"] or 0
    groups, ranges = int(total // group_bytes) + 1, int(total // range_bytes) + 1
    ident = F.col(f"`{id_col}`").cast("bigint")
    rows = docs.select(ident.alias("id"), text.alias("text"), F.pmod(F.xxhash64(ident), F.lit(groups)).alias("grp"))

    def send_anchors(key, table):
        hashes = np.unique(anchors(Words(texts_of(ordered(table))), window)[1])
        bounds = cut(hashes, ranges)
        filled = np.flatnonzero(np.diff(bounds))
        return pa.table(
            {
                "grp": pa.array([key[0].as_py()] * len(filled), pa.int64()),
                "range": pa.array(filled, pa.int32()),
                "hashes": pa.array([hashes[bounds[i] : bounds[i + 1]].tobytes() for i in filled], pa.binary()),
            }
        )

    def repeated(table):
        parts = [np.frombuffer(x, np.uint64) for x in table["hashes"].to_pylist()]
        hashes = np.concatenate(parts)
        order = np.argsort(hashes, kind="stable")
        same = hashes[order][1:] == hashes[order][:-1]
        flags = np.zeros(len(hashes), bool)
        flags[order[1:]] |= same
        flags[order[:-1]] |= same
        return _split(flags, table, [len(p) for p in parts])

    def flagged(words: Words, bits: pa.Table) -> np.ndarray:
        count = len(np.unique(anchors(words, window)[1]))
        return candidates(words, window, joined_bits(bits, count))

    def send_windows(key, table, bits):
        table = ordered(table)
        words = Words(texts_of(table))
        starts = flagged(words, bits)
        a, b, first, _ = distinct_windows(words, window, starts)
        doc = ids_of(table)[np.searchsorted(words.first, first, side="right") - 1]
        bounds = cut(a, ranges)
        filled = np.flatnonzero(np.diff(bounds))
        slices = [slice(bounds[i], bounds[i + 1]) for i in filled]
        return pa.table(
            {
                "grp": pa.array([key[0].as_py()] * len(filled), pa.int64()),
                "range": pa.array(filled, pa.int32()),
                "a": pa.array([a[s].tobytes() for s in slices], pa.binary()),
                "b": pa.array([b[s].tobytes() for s in slices], pa.binary()),
                "doc": pa.array([doc[s].tobytes() for s in slices], pa.binary()),
            }
        )

    def later(table):
        parts = [np.frombuffer(x, np.uint64) for x in table["a"].to_pylist()]
        a = np.concatenate(parts)
        b = np.frombuffer(b"".join(table["b"].to_pylist()), np.uint64)
        doc = np.frombuffer(b"".join(table["doc"].to_pylist()), np.int64)
        order = np.lexsort((doc, b, a))
        flags = np.zeros(len(a), bool)
        flags[order[1:]] = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
        return _split(flags, table, [len(p) for p in parts])

    def keep(key, table, both):
        table = ordered(table)
        words = Words(texts_of(table))
        step = np.array(both["step"].to_pylist())
        starts = flagged(words, both.filter(pa.array(step == 1)) if len(step) else both)
        a, _, first, number = distinct_windows(words, window, starts)
        elsewhere = joined_bits(both.filter(pa.array(step == 2)) if len(step) else both, len(a))
        gone = np.zeros(len(words.hashes) + 1, np.int64)
        gone[starts[elsewhere[number] | (starts != first[number])]] = 1
        upto = np.cumsum(gone)[:-1]
        covered = upto.copy()
        covered[window:] -= upto[:-window]
        out = {"id": table["id"], "n_words": [], "n_removed": [], "kept_text": []}
        for i in range(table.num_rows):
            low, high = words.first[i], words.first[i + 1]
            left = covered[low:high] == 0
            parts = words.text(i).split()
            out["n_words"].append(high - low)
            out["n_removed"].append(high - low - int(left.sum()))
            out["kept_text"].append(b" ".join(parts if left.all() else compress(parts, left)).decode())
        out["kept_sha256"] = [hashlib.sha256(t.encode()).hexdigest() for t in out["kept_text"]]
        return pa.table(out, schema=result)

    result = pa.schema(
        [("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string()), ("kept_sha256", pa.string())]
    )
    back = "grp bigint, range int, n int, bits binary"
    grouped = rows.groupBy("grp")
    sent = grouped.applyInArrow(send_anchors, "grp bigint, range int, hashes binary")
    first = sent.groupBy("range").applyInArrow(repeated, back)
    wide = "grp bigint, range int, a binary, b binary, doc binary"
    extended = grouped.cogroup(first.groupBy("grp")).applyInArrow(send_windows, wide)
    second = extended.groupBy("range").applyInArrow(later, back)
    both = first.withColumn("step", F.lit(1)).unionByName(second.withColumn("step", F.lit(2)))
    return grouped.cogroup(both.groupBy("grp")).applyInArrow(
        keep, "id bigint, n_words bigint, n_removed bigint, kept_text string, kept_sha256 string"
    )
