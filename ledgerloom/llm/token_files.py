"""Token ids in Arrow files of equal-length sequences.

The texts are encoded where they are read. Documents are cut into ranges of ascending id with about `range_bytes` of text
each, and each range becomes one Arrow IPC file that states its range and its number of ids; those of the files before it are
its offset in the whole stream. Its record batches hold two fixed-size-list columns, `ids` and `mask` (false on the padding of the last sequence), so
sequence k is a slice of a memory-mapped buffer without a copy or a decoder; `doc_ids` and `doc_lengths` name the
documents that start in a sequence.

Files are written and read by Spark's own sources, so they reach any store that Spark reaches and a lost task leaves no
half file: the text sink writes the bytes of one row per file, its "line separator" being the last byte of the Arrow
trailer, and the binary-file source reads them back.

Defined cases: a null text is empty and yields the end id alone; rows with one id follow each other in text order; a
null id comes first; an empty table gives no file and an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAGIC_END = b"1"  # last byte of the trailing "ARROW1" of an Arrow IPC file
RANGE_BYTES = 4 << 20
CACHED_WORDS = 300_000
_TAIL = ".,;:!?)"  # punctuation that is one piece of its own behind letters


class WordEncoder:
    """Ids of texts by a tokenizer that drops white space before it splits, so that words are encoded once and remembered.

    Most words are one run of letters with or without punctuation behind it, which the pre-tokenizer splits in two. Such
    pieces are remembered, too, and new ones are encoded many at a time: the last token of a piece has the word-end
    mark. Any other word is encoded by itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.width = np.dtype("<u2") if max(vocabulary.values()) < 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.width.itemsize == 2 else "I"
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.words: dict[bytes, bytes] = {}
        self.older_words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.width) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def _recalled(wanted: set, older: dict, young: dict) -> list:
        """What of `wanted` is in neither half; what the older half has moves to the young one."""
        new = []
        for key in wanted:
            ids = older.get(key)
            if ids is None:
                new.append(key)
            else:
                young[key] = ids
        return new

    def _learn_pieces(self, wanted: set[str]) -> None:
        tokenize, code = self.tokenizer.model.tokenize, struct.Struct
        new = []
        for piece in self._recalled(wanted, self.older, self.pieces):
            if piece.isascii() and piece.isalpha():  # nothing to normalise or split: straight to the merges
                ids = [t.id for t in tokenize(piece)]
                self.pieces[piece] = code(f"<{len(ids)}{self.code}").pack(*ids)
            else:
                new.append(piece)
        for low in range(0, len(new), 10_000):
            part = new[low : low + 10_000]
            ids = self._ids([" ".join(part)])[0]
            cuts = np.concatenate([[0], np.flatnonzero(self.ends[ids]) + 1]) * self.width.itemsize
            raw = ids.tobytes()
            if len(cuts) != len(part) + 1 or cuts[-1] != len(raw):
                self.pieces.update(zip(part, (x.tobytes() for x in self._ids(part))))
                continue
            for piece, a, b in zip(part, cuts[:-1].tolist(), cuts[1:].tolist()):
                self.pieces[piece] = raw[a:b]

    def _learn(self, new: list[bytes]) -> None:
        words = b" ".join(new).decode().split(" ")
        stems = [w.rstrip(_TAIL) for w in words]
        tails = [w[len(s) :] for w, s in zip(words, stems)]
        stems = [s.lower() if s.isascii() else s for s in stems]
        plain = [s.isalpha() and (s.isascii() or s.lower().isalpha()) for s in stems]
        known = self.pieces
        self._learn_pieces({s for s, p in zip(stems, plain) if p}.union(tails).difference(known, [""]))
        known[""] = b""
        self.words.update((w, known[s] + known[t]) for w, s, t, p in zip(new, stems, tails, plain) if p)
        odd = [i for i, p in enumerate(plain) if not p]
        if odd:
            self.words.update(zip([new[i] for i in odd], [x.tobytes() for x in self._ids([words[i] for i in odd])]))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian ids of each text."""
        split = [t.split() for t in texts]
        if len(self.words) > CACHED_WORDS:  # dropped before a batch, never inside it; frequent words come back from the older half
            self.older_words, self.words = self.words, {}
        if len(self.pieces) > CACHED_WORDS // 2:  # frequent pieces come back from the older half
            self.older, self.pieces = self.pieces, {}
        new = set().union(*split).difference(self.words)
        if new:
            new = self._recalled(new, self.older_words, self.words)
        if new:
            self._learn(new)
        known = self.words.__getitem__
        return [b"".join(map(known, words)) for words in split]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def pieces_of(column: pa.Array, size: int = 1 << 20):
    """Slices of a text column with about `size` bytes each, as lists of bytes."""
    part, held = [], 0
    for value in column:
        raw = value.as_buffer().to_pybytes() if value.is_valid else b""
        part.append(raw)
        held += len(raw)
        if held >= size:
            yield part
            part, held = [], 0
    if part:
        yield part


def encode_table(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int, range_bytes: int) -> DataFrame:
    """(range, id, text order key, n, ids) of every document, ids little-endian with the end id appended."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    ident = F.col(f"`{id_col}`").cast("bigint")
    total = docs.agg(F.sum(F.octet_length(text)).alias("b")).first()["b"] or 0
    ranges = int(total // range_bytes) + 1
    cuts = np.zeros(0, np.int64)
    if ranges > 1:
        at = [(i + 1) / ranges for i in range(ranges - 1)]
        low = docs.agg(F.percentile_approx(ident, at, 20 * ranges).alias("cuts")).first()["cuts"]
        cuts = np.unique(np.array(low or [], np.int64))

    def encode(batches):
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.width).tobytes()
        for batch in batches:
            ids = pc.fill_null(batch.column("id"), int(np.iinfo(np.int64).min)).to_numpy(zero_copy_only=False)
            where, done = np.searchsorted(cuts, ids, side="left"), 0
            for part in pieces_of(batch.column("text")):
                coded = [x + end for x in enc.encode(part)]
                rows = slice(done, done + len(part))
                done += len(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(where[rows], pa.int32()),
                        batch.column("id")[rows],
                        pa.array([zlib.crc32(t) for t in part], pa.int64()),
                        pa.array([len(x) // enc.width.itemsize for x in coded], pa.int64()),
                        pa.array(coded, pa.binary()),
                    ],
                    names=["range", "id", "tie", "n", "ids"],
                )

    rows = docs.select(ident.alias("id"), text.alias("text"))
    return rows.mapInArrow(encode, "range int, id bigint, tie bigint, n bigint, ids binary")


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 2,
    length: int = 2048,
    batch: int = 256,
    range_bytes: int = RANGE_BYTES,
) -> None:
    """Write the token stream in ascending id order. `length` ids make a sequence, `batch` sequences a record batch.

    One range (its texts' ids) is held by one task; `range_bytes` bounds it, whatever the size of the table.
    """
    encoded = encode_table(docs, id_col, text_col, tokenizer, end_id, range_bytes)
    width = encoder(tokenizer).width

    def one_file(key, table):
        number = key[0].as_py()
        table = table.take(pc.sort_indices(table, sort_keys=[("id", "ascending"), ("tie", "ascending")], null_placement="at_start"))
        ids = np.frombuffer(b"".join(x.as_buffer() for x in table["ids"]), width)
        sequences = -(-len(ids) // length)
        flat = np.zeros(sequences * length, width)
        flat[: len(ids)] = ids
        mask = np.arange(len(flat)) < len(ids)
        n = table["n"].to_numpy()
        starts = np.cumsum(n) - n
        bounds = np.searchsorted(starts // length, np.arange(sequences + 1))
        lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), c.combine_chunks().cast(pa.int64())) for c in (table["id"], table["n"])]
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(a), length) for a in (flat, mask)] + lists
        whole = pa.Table.from_arrays(columns, names=["ids", "mask", "doc_ids", "doc_lengths"])
        whole = whole.replace_schema_metadata({"range": str(number), "ids": str(len(ids))})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_file(sink, whole.schema) as writer:
            writer.write_table(whole, max_chunksize=batch)
        data = sink.getvalue().to_pybytes()
        if not data.endswith(MAGIC_END):
            raise ValueError("not an Arrow file")
        return pa.table({"data": pa.array([data[: -len(MAGIC_END)]], pa.binary())})

    files = encoded.groupBy("range").applyInArrow(one_file, "data binary")
    (
        files.select(F.col("data").cast("string").alias("value"))
        .write.option("lineSep", MAGIC_END.decode()).option("maxRecordsPerFile", 1).text(folder)
    )


def open_file(data) -> pa.ipc.RecordBatchFileReader:
    """Reader of one file: a path to memory-map, or bytes."""
    return pa.ipc.open_file(pa.memory_map(data) if isinstance(data, str) else pa.BufferReader(data))


def sequence(reader: pa.ipc.RecordBatchFileReader, k: int, batch: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask of sequence k; the ids are a view of the file's buffer."""
    rows = reader.get_batch(k // batch)
    size, at = rows.column("ids").type.list_size, k % batch
    ids = rows.column("ids").values.to_numpy(zero_copy_only=True)[at * size : (at + 1) * size]
    return ids, rows.column("mask").values.slice(at * size, size).to_numpy(zero_copy_only=False)


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """Per document, from the files alone: id, start in the whole stream, n_tokens, ids_crc32 and, if asked for, ids."""
    content = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder).select("content")

    def counts(batches):
        for batch in batches:
            meta = [open_file(x.as_buffer()).schema.metadata for x in batch.column("content")]
            yield pa.RecordBatch.from_arrays([pa.array([int(m[k]) for m in meta], pa.int64()) for k in (b"range", b"ids")], names=["range", "n"])

    sizes = sorted(tuple(r) for r in content.mapInArrow(counts, "range bigint, n bigint").collect())  # a row per file
    first = dict(zip([r for r, _ in sizes], np.cumsum([0, *[n for _, n in sizes]]).tolist()))

    def rows(batches):
        for batch in batches:
            for data in batch.column("content"):
                reader = open_file(data.as_buffer())
                meta = reader.schema.metadata
                parts = [reader.get_batch(i) for i in range(reader.num_record_batches)]
                flat = np.concatenate([p.column("ids").flatten().to_numpy() for p in parts])
                mask = np.concatenate([p.column("mask").flatten().to_numpy(zero_copy_only=False) for p in parts])
                flat = flat[mask].astype("<u4")
                names = pa.concat_arrays([p.column("doc_ids").flatten() for p in parts])
                n = np.concatenate([p.column("doc_lengths").flatten().to_numpy() for p in parts])
                ends = np.cumsum(n)
                if len(flat) != int(meta[b"ids"]) or (len(ends) and ends[-1] != len(flat)):
                    raise ValueError("a token file is not whole")
                for low in range(0, len(n), 512):
                    part = slice(low, low + 512)
                    ids = [flat[a:b] for a, b in zip((ends - n)[part], ends[part])]
                    yield pa.RecordBatch.from_arrays(
                        [
                            names[part],
                            pa.array(first[int(meta[b"range"])] + (ends - n)[part], pa.int64()),
                            pa.array(n[part], pa.int64()),
                            pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                            *([pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))] if with_ids else []),
                        ],
                        names=["id", "start", "n_tokens", "ids_crc32", "ids"][: 4 + with_ids],
                    )

    return content.mapInArrow(rows, "id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids)
