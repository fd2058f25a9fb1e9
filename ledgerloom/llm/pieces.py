"""SentencePiece encoding and decoding, driven by an Aho-Corasick automaton over the pieces.

The automaton reports, for every position, all pieces that end there (its output links, longest first). What becomes of
them depends on how the file was trained, as in the library:

- unigram: each piece relaxes the best score at its end from the one at its start, so one pass over the text leaves the best
  segmentation (Viterbi). A character that no piece covers costs more than any piece.
- merges (BPE): scores are merge ranks, and the sum of ranks means nothing. Starting from characters, the neighbours whose
  union is the piece of the best rank, the leftmost of equals, are joined until no neighbours make a piece. What is left of
  a prefix of the text has one last piece, and any two neighbours are what is left of the two alone. So the same pass
  does it: a piece that ends here extends the prefix at its start if the two stay apart, and the first output link that does
  settles the position. Whether two pieces stay apart is found by joining them once, and remembered.

A character that is left and is no piece becomes its UTF-8 bytes (or the unknown id). The functions on tables give the ids of
the library's `encode` for files of both kinds (a file with user-defined or unused pieces is an error); `coder` reads any file by its scores.

No piece has a space mark behind another character, so a text falls apart in front of its spaces without loss; the ids of
such a part are remembered in two generations (the older one is dropped when the younger is full, and what is met again
moves up), and only new parts go through the automaton. If a file has pieces across spaces, the whole
text is one part.

Defined cases: null and empty texts have no ids; the space mark itself (U+2581) in a text reads as a space, as in the
library; decoding gives back every other text exactly; repeated rows are encoded alike; an empty table gives an empty
result; other columns of the table are kept in front.
"""

from __future__ import annotations

import heapq
import re
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.token_files import pieces_of

MARK = "▁"
REMEMBERED = 300_000  # parts of a generation
PAIRS = 500_000  # pairs of a generation
_PARTS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class PieceCoder:
    """Pieces, scores and automaton of one model file."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.automaton = ahocorasick.Automaton()
        size = model.vocab_size()
        self.unknown, self.bytes, self.raw, scores, self.single = model.unk_id(), [None] * 256, [b""] * size, [], set()
        self.names = [""] * size
        whole = True
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:-1], 16)] = i
                self.raw[i] = bytes([int(piece[3:-1], 16)])
            elif i == self.unknown:
                self.raw[i] = " ⁇ ".encode()
            elif not (model.is_control(i) or model.is_unused(i)):
                self.raw[i] = piece.replace(MARK, " ").encode()
                self.names[i] = piece
                self.automaton.add_word(piece, (model.get_score(i), len(piece), i))
                scores.append(model.get_score(i))
                whole = whole and MARK not in piece.lstrip(MARK)
                if len(piece) == 1:
                    self.single.add(piece)
        self.automaton.make_automaton()
        self.apart = whole
        self.penalty = min(scores, default=0.0) - 10.0  # of an uncovered character, below every piece
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def segment(self, text: str) -> list[int]:
        """Ids of the best segmentation of a marked text."""
        n = len(text)
        best, came = [float("-inf")] * (n + 1), [None] * (n + 1)
        best[0], settled = 0.0, 0

        def settle(upto: int) -> None:
            """Characters that are no piece of their own may stand alone as unknown."""
            nonlocal settled
            while settled < upto:
                settled += 1
                score = best[settled - 1] + self.penalty
                if text[settled - 1] not in self.single and score > best[settled]:
                    best[settled], came[settled] = score, (1, -1)

        for end, (gain, length, number) in self.automaton.iter(text):
            settle(end)
            score = best[end + 1 - length] + gain
            if score > best[end + 1]:
                best[end + 1], came[end + 1] = score, (length, number)
        settle(n)
        out, at = [], n
        while at:
            length, number = came[at]
            if number >= 0:
                out.append(number)
            else:
                out += self.codes(text[at - 1])[::-1]
            at -= length
        return out[::-1]

    def codes(self, character: str) -> list[int]:
        """Ids of a character that no piece covers."""
        codes = [self.bytes[b] for b in character.encode("utf-8", "surrogatepass")]
        return [self.unknown] if None in codes else codes

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers."""
        if not text:
            return b""
        if len(self.known) > REMEMBERED:  # before a text, never inside it
            self.older, self.known = self.known, {}
        marked = MARK + text.replace(" ", MARK)
        parts = _PARTS.findall(marked) if self.apart else [marked]
        known, older = self.known, self.older
        new = set(parts).difference(known)
        for part in new:
            ids = older.get(part)
            if ids is None:
                found = self.segment(part)
                ids = struct.pack(f"<{len(found)}i", *found)
            known[part] = ids
        out = b"".join(map(known.__getitem__, parts))
        for part in new:
            if len(part) >= 100:
                del known[part]
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of a list of ids; the first space belongs to the encoding."""
        raw = self.raw
        text = b"".join([raw[i] for i in ids]).decode("utf-8", "replace")
        return text.removeprefix(" ")


class MergeCoder(PieceCoder):
    """Of the pieces that the automaton finds in a text, those that the merge order of the file leaves."""

    def __init__(self, path: str):
        super().__init__(path)
        self.pairs: dict[int, bool] = {}
        self.older_pairs: dict[int, bool] = {}
        self.alone: dict[int, bool] = {}  # whether a piece is what is left of its own text
        self.closed = all(self.single.issuperset(name) for name in self.names)

    def segment(self, text: str) -> list[int]:
        """One pass over the automaton: each position keeps the one last piece of the prefix that ends there."""
        if not self.single.issuperset(text):
            return self._around_others(text) if self.closed else self.merged(text)
        if len(self.pairs) > PAIRS:
            self.older_pairs, self.pairs = self.pairs, {}
        n, size, known = len(text), len(self.names), self.pairs.get
        last, came = [-1] * (n + 1), [0] * (n + 1)
        for end, (_, length, number) in self.automaton.iter(text):
            end += 1
            if last[end] >= 0:
                continue
            start = end - length
            if start:
                before = last[start]
                if before < 0:
                    continue
                apart = known(before * size + number)
                if apart is None:
                    apart = self._stay_apart(before, number)
            else:
                apart = self.alone.get(number)
                if apart is None:
                    apart = self.alone[number] = self.merged(self.names[number]) == [number]
            if apart:
                last[end], came[end] = number, start
        if last[n] < 0:
            raise ValueError("no piece ends the text")  # every character is a piece, so one does
        out, at = [], n
        while at:
            out.append(last[at])
            at = came[at]
        return out[::-1]

    def _stay_apart(self, first: int, second: int) -> bool:
        """Whether joining the text of two pieces leaves these two."""
        key = first * len(self.names) + second
        apart = self.older_pairs.get(key)
        if apart is None:
            apart = self.merged(self.names[first] + self.names[second]) == [first, second]
        self.pairs[key] = apart
        return apart

    def _around_others(self, text: str) -> list[int]:
        """Characters that no piece has stand alone, and nothing is joined across them."""
        out, start = [], 0
        for i, character in enumerate(text):
            if character not in self.single:
                out += self.segment(text[start:i]) if i > start else []
                out += self.codes(character)
                start = i + 1
        return out + (self.segment(text[start:]) if start < len(text) else [])

    def merged(self, text: str) -> list[int]:
        """The merges themselves, one after the other."""
        n = len(text)
        found = {}
        for end, (score, length, number) in self.automaton.iter(text):
            found[end + 1 - length, end + 1] = (-score, number)
        ends, starts = list(range(1, n + 1)), list(range(-1, n))  # end of the symbol at i; start of the symbol that ends at i
        heap = [(found[i, i + 2][0], i, i + 1, i + 2) for i in range(n - 1) if (i, i + 2) in found]
        heapq.heapify(heap)
        while heap:
            _, start, middle, end = heapq.heappop(heap)
            if ends[start] != middle or ends[middle] != end:
                continue  # one of the two has been joined to another
            ends[start], ends[middle], starts[end] = end, 0, start
            if start:
                before = starts[start]
                if (before, end) in found:
                    heapq.heappush(heap, (found[before, end][0], before, start, end))
            if end < n:
                after = ends[end]
                if (start, after) in found:
                    heapq.heappush(heap, (found[start, after][0], start, end, after))
        out, at = [], 0
        while at < n:
            end = ends[at]
            if (at, end) in found:
                out.append(found[at, end][1])
            else:
                out += self.codes(text[at])
            at = end
        return out


@lru_cache(maxsize=2)
def coder(path: str) -> PieceCoder:
    """Coder of a file by its scores, whatever it was trained for."""
    return PieceCoder(path)


@lru_cache(maxsize=2)
def library_coder(path: str) -> PieceCoder:
    """Coder of a file by the method it was trained for."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    kinds = {model.trainer_spec.UNIGRAM: coder, model.trainer_spec.BPE: MergeCoder}
    if model.trainer_spec.model_type not in kinds:
        raise ValueError("the file is neither a unigram nor a merge model")
    if any(p.type in (p.USER_DEFINED, p.UNUSED) for p in model.pieces):
        raise ValueError("files with user-defined or unused pieces are not supported")
    return kinds[model.trainer_spec.model_type](path)


def encode(docs: DataFrame, model: str, text_col: str = "text", name: str = "piece_ids") -> DataFrame:
    """`docs` with an array of piece ids after its own columns. `model` is the path of a SentencePiece file."""
    return _mapped(docs, text_col, name, "array<int>", lambda texts: _encoded(library_coder(model), texts))


def round_trip(docs: DataFrame, model: str, text_col: str = "text", name: str = "piece_ids", check: str = "round_trip") -> DataFrame:
    """As `encode`, with a flag whether decoding the ids gives the text back, too."""

    def both(texts):
        code = library_coder(model)
        ids = _encoded(code, texts)
        ends = ids.offsets.to_numpy()
        flat = ids.values.to_numpy()
        same = [
            code.decode(flat[a:b].tolist()) == t.decode().replace(MARK, " ") for t, a, b in zip(texts, ends[:-1], ends[1:])
        ]
        return pa.StructArray.from_arrays([ids, pa.array(same, pa.bool_())], names=["ids", "same"])

    whole = _mapped(docs, text_col, "both", "struct<ids: array<int>, same: boolean>", both)
    names = docs.columns
    inner = whole.toDF(*[f"c{i}" for i in range(len(names))], "both")
    return inner.select(*[f"c{i}" for i in range(len(names))], "both.ids", "both.same").toDF(*names, name, check)


def decode(coded: DataFrame, model: str, ids_col: str = "piece_ids", name: str = "text") -> DataFrame:
    """`coded` with the decoded text after its own columns; null ids decode to the empty text."""
    names = coded.columns

    def texts(batches):
        code = library_coder(model)
        for batch in batches:
            column = [code.decode(x.as_py() or []) for x in batch.column(names.index(ids_col))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(column, pa.string())], names=[f"c{i}" for i in range(len(names) + 1)])

    return _run(coded, texts, "string").toDF(*names, name)


def _encoded(code: PieceCoder, texts: list[bytes]) -> pa.ListArray:
    coded = [code.encode(t.decode()) for t in texts]
    ends = np.cumsum([0, *[len(x) // 4 for x in coded]])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(coded), "<i4")))


def _run(docs: DataFrame, function, kind: str) -> DataFrame:
    fields = [f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields)]
    rows = docs.toDF(*[f"c{i}" for i in range(len(fields))])
    return rows.mapInArrow(function, ", ".join([*fields, f"c{len(fields)} {kind}"]))


def _mapped(docs: DataFrame, text_col: str, name: str, kind: str, function) -> DataFrame:
    """Append a column computed from about a megabyte of texts at a time."""
    names = docs.columns

    def run(batches):
        for batch in batches:
            done = 0
            for texts in pieces_of(batch.column(names.index(text_col))):
                part = batch.slice(done, len(texts))
                done += len(texts)
                yield pa.RecordBatch.from_arrays([*part.columns, function(texts)], names=[f"c{i}" for i in range(len(names) + 1)])

    return _run(docs, run, kind).toDF(*names, name)
