"""Document fingerprints from content-defined chunks, and containment between them.

A gear hash runs over the bytes of a text: at each byte it is the sum of the table values of the last 32 bytes, each shifted
by its distance, so it depends on these bytes alone. A chunk ends where some bits of the hash are zero. Lengths are
normalised: more bits have to be zero before the normal length than after it, none ends before the shortest length
and each ends at the longest. An insertion or deletion therefore changes the chunks it touches, and the later ones
are found again wherever they now lie. Bounds never fall inside a character.

A fingerprint is the set of chunk digests (64 bits of BLAKE2b), each with the number of characters its chunks cover in the
text: `digest:characters` in ascending order, joined by commas. The containment of a fingerprint in another one is the share
of its characters whose chunks the other has too.

Texts are hashed in bounded slabs of a batch, whole; the table is shuffled only where neighbours in id order are compared
(`compare_with_next`): rows are range-partitioned by id, a task streams its range in order, and only the first and the last
row of each range meet again in a join.

Defined cases: a null text is the empty text, whose fingerprint is the empty text; an empty fingerprint is contained in
an empty one (1.0) and shares nothing with others (0.0); equal texts have equal fingerprints, chunks that repeat in a text
are one entry; rows of one id follow each other in the order of their hashes and texts; a null id comes after all others;
an empty table gives an empty result; other columns are ignored, whatever they are called.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.storage import saved

REACH = 32  # bytes that a 32-bit gear hash depends on
SLAB = 4 << 20  # bytes hashed at a time
GEAR = np.random.Generator(np.random.PCG64(13)).integers(0, 2**32, 256, dtype=np.uint32)


@dataclass(frozen=True)
class Chunking:
    """Chunk lengths in bytes; `shortest` is at least the reach of the hash, so no hash looks across a bound."""

    shortest: int = 32
    normal: int = 128
    longest: int = 512
    strict: int = 8  # zero bits asked for before the normal length
    loose: int = 5  # and after it

    def __post_init__(self):
        if not REACH <= self.shortest < self.normal < self.longest or not 0 < self.loose < self.strict < 32:
            raise ValueError("lengths from 32 ascending, and 0 < loose < strict < 32")


def gear_hashes(raw: np.ndarray) -> np.ndarray:
    """Gear hash at each byte, by doubling the number of bytes that it covers."""
    h = GEAR[raw]
    span = 1
    while span < REACH:
        ahead = np.zeros_like(h)
        ahead[span:] = h[:-span] << np.uint32(span)
        h = h + ahead
        span *= 2
    return h


def bounds(data: bytes, by: Chunking = Chunking()) -> list[int]:
    """Ends of the chunks of a text in UTF-8, in order."""
    raw = np.frombuffer(data, np.uint8)
    loose_bits, strict_bits = (np.uint32(2**32 - 2 ** (32 - n)) for n in (by.loose, by.strict))
    loose, strict = [], []
    for start in range(0, len(raw), SLAB):
        from_ = max(0, start - REACH + 1)
        h = gear_hashes(raw[from_ : start + SLAB])[start - from_ :]
        ends = np.flatnonzero((h & loose_bits) == 0)
        strict.append(ends[(h[ends] & strict_bits) == 0] + start + 1)
        loose.append(ends + start + 1)
    loose = np.concatenate(loose).tolist() if loose else []
    strict = np.concatenate(strict).tolist() if strict else []
    out, at, size = [], 0, len(data)
    while at < size:
        end = min(at + by.longest, size)
        i = bisect_left(strict, at + by.shortest)
        if i < len(strict) and strict[i] < at + by.normal:
            end = min(end, strict[i])
        else:
            i = bisect_left(loose, at + by.normal)
            if i < len(loose):
                end = min(end, loose[i])
        while end < size and data[end] & 0xC0 == 0x80:  # inside a character
            end += 1
        out.append(end)
        at = end
    return out


def chunk_weights(data: bytes, by: Chunking = Chunking()) -> dict[str, int]:
    """Characters covered per chunk digest."""
    found: dict[str, int] = {}
    start = 0
    for end in bounds(data, by):
        piece = data[start:end]
        key = hashlib.blake2b(piece, digest_size=8).hexdigest()
        found[key] = found.get(key, 0) + len(piece.decode())
        start = end
    return found


def written(weights: dict[str, int]) -> str:
    return ",".join(f"{k}:{weights[k]}" for k in sorted(weights))


def parsed(fingerprint: str) -> dict[str, int]:
    return {k: int(n) for k, n in (e.split(":") for e in fingerprint.split(","))} if fingerprint else {}


def containment(inner: dict[str, int], outer: dict[str, int]) -> float:
    """Share of the characters of `inner` whose chunks `outer` has."""
    if not inner:
        return 0.0 if outer else 1.0
    return sum(n for k, n in inner.items() if k in outer) / sum(inner.values())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by: Chunking = Chunking()) -> DataFrame:
    """(id, n_chars, fingerprint) of every row; nothing is shuffled."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))

    def scan(batches):
        for batch in batches:
            texts = batch.column("text")
            prints = [written(chunk_weights(t.as_buffer().to_pybytes(), by)) for t in texts]
            sizes = pa.array([len(t.as_py()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), sizes, pa.array(prints, pa.string())], names=["id", "n_chars", "fingerprint"])

    return rows.mapInArrow(scan, f"id {rows.schema['id'].dataType.simpleString()}, n_chars bigint, fingerprint string")


def spliced(text: str, following: str) -> str:
    """The text with its last half replaced by as many first characters of the following one (or all it has)."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


@dataclass
class Row:
    """A text and its chunk weights, worked out once for its own row and for the row before it."""

    key: int | None
    text: str
    by: Chunking

    def __post_init__(self):
        self.weights = chunk_weights(self.text.encode(), self.by)

    def against(self, following: Row) -> tuple:
        edited = spliced(self.text, following.text).encode()
        other = chunk_weights(edited, self.by)
        return (
            self.key, len(self.text), hashlib.sha256(edited).hexdigest(), written(self.weights), written(other),
            containment(self.weights, other), containment(self.weights, following.weights),
        )


RESULT = "id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
FIELDS = [
    ("id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
]
EDGE = "part int, is_last boolean, text string"
EDGE_FIELDS = [("part", pa.int32()), ("is_last", pa.bool_()), ("text", pa.string())]
OUT_ROWS, OUT_BYTES = 2000, 8 << 20  # a batch of results is sent off at either


def _sent(rows: Iterator[tuple], fields: list[tuple[str, pa.DataType]]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    schema = pa.schema(fields)

    def batch():
        columns = zip(*held)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], schema=schema)

    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= OUT_ROWS or size >= OUT_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _cells(batches, *names: str) -> Iterator[tuple]:
    """Rows of Arrow batches, one Python value at a time."""
    for batch in batches:
        columns = [batch.column(n) for n in names]
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in columns)


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by: Chunking = Chunking()) -> DataFrame:
    """Each row with its spliced text and the next row by descending id (after the last comes the first).

    Ids are integers. Columns: id, n_chars (of the text), edited_sha256 (of the spliced text), fingerprint,
    edited_fingerprint, and the containment of the fingerprint in those of the spliced and of the next text.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    keys = [F.desc_nulls_last("id"), F.asc("hash")]
    rows = rows.withColumn("hash", F.xxhash64("text")).withColumn("tie", F.rand(13))  # equal rows may be parted
    ranged = rows.repartitionByRange(*keys, "tie").sortWithinPartitions(*keys, "text").select("id", "text")
    none = (None,) * len(EDGE_FIELDS)

    def scan(batches):
        part = TaskContext.get().partitionId()

        def found():
            last = None
            for key, text in _cells(batches, "id", "text"):
                row = Row(key, text, by)
                if last is None:
                    yield (None,) * len(FIELDS) + (part, False, text)
                else:
                    yield last.against(row) + none
                last = row
            if last is not None:
                yield (last.key, *(None,) * (len(FIELDS) - 1), part, True, last.text)

        yield from _sent(found(), FIELDS + EDGE_FIELDS)

    done = saved(ranged.mapInArrow(scan, f"{RESULT}, {EDGE}"), "chunk-prints", "zstd")
    # two rows per range of the table: the last of each is compared with the first of the next one that has rows
    edges = done.filter("part is not null")
    order = edges.filter("not is_last").select(
        "part", F.expr("coalesce(lead(part) over (order by part), min(part) over ())").alias("next_part")
    )
    firsts = edges.filter("not is_last").select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    pairs = edges.filter("is_last").select("id", "text", "part").join(order, "part").join(firsts, "next_part").select("id", "text", "following")

    def pair(batches):
        yield from _sent((Row(k, t, by).against(Row(None, f, by)) for k, t, f in _cells(batches, "id", "text", "following")), FIELDS)

    names = [n for n, _ in FIELDS]
    return done.filter("part is null").select(*names).unionByName(pairs.mapInArrow(pair, RESULT))
