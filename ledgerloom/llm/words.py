"""Vectorised words and window hashes of a batch of texts (numpy over the UTF-8 bytes)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes that end a word: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = b" \t\n\x0b\x0c\r"
_IS_SPACE = np.isin(np.arange(256), np.frombuffer(SPACES, np.uint8))
_RANDOM = np.random.Generator(np.random.PCG64(20)).integers(1, 2**63, 256 + 4, dtype=np.uint64)
_BYTE = _RANDOM[:256]
_BASES = [int(x) * 8 + 3 for x in _RANDOM[256:]]  # odd, so each has an inverse modulo 2^64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 bits of the result (splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_KEPT_BITS = 20
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(which: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """At least `size` powers of a base and of its inverse. Short tables are kept, that of a very long text is not."""
    if which in _TABLES and len(_TABLES[which][0]) >= size:
        return _TABLES[which]
    count = 1 << max(_KEPT_BITS, size.bit_length())
    base = _BASES[which] % 2**64
    up = np.full(count, base, np.uint64)
    down = np.full(count, pow(base, -1, 2**64), np.uint64)
    up[0] = down[0] = 1
    table = np.cumprod(up), np.cumprod(down)
    if count == 1 << _KEPT_BITS:
        _TABLES[which] = table
    return table


def spans(values: np.ndarray, start: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
    """Polynomial hash of values[start:end] for each pair, by prefix sums; equal slices give equal hashes."""
    up, down = _powers(which, len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start])


class Words:
    """The words of a list of texts, laid end to end.

    `hashes` has a 64-bit hash per word, `first` the number of words before each text (one more entry than texts),
    `start` and `end` the byte range of each word in `data`. `separator` says which bytes end a word, `fold` maps bytes
    before they are hashed.
    """

    def __init__(self, texts: pa.Array, separator: np.ndarray = _IS_SPACE, fold: np.ndarray | None = None):
        texts = pc.fill_null(texts.cast(pa.large_string()), "").cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        base, stop = (int(offsets[0]), int(offsets[-1])) if len(texts) else (0, 0)
        self.data = memoryview(texts.buffers()[2] or b"")[base:stop]
        self.offsets = offsets - base if len(texts) else np.zeros(1, np.int64)
        raw = np.frombuffer(self.data, np.uint8)
        inside = ~separator[raw]
        before, after = np.zeros_like(inside), np.zeros_like(inside)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        cuts = self.offsets[(self.offsets > 0) & (self.offsets < len(raw))]
        before[cuts], after[cuts - 1] = False, False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, self.offsets)
        self.codes = _BYTE[raw if fold is None else fold[raw]]
        self.hashes = spans(self.codes, self.start, self.end, 0) if len(raw) else np.zeros(0, np.uint64)

    def windows(self, size: int, which: int = 1) -> np.ndarray:
        """Hash of the `size` words from each word on; only those inside one text mean anything, see `fits`."""
        n = len(self.hashes)
        start = np.arange(n)
        return spans(self.hashes, start, np.minimum(start + size, n), which) if n else np.zeros(0, np.uint64)

    def beginnings(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Words longer than `size` bytes, and a hash of the first `size` bytes of each."""
        long = np.flatnonzero(self.end - self.start > size)
        if not len(long):
            return long, np.zeros(0, np.uint64)
        return long, spans(self.codes, self.start[long], self.start[long] + size, 3)

    def place(self) -> np.ndarray:
        """Position of each word in its text."""
        return np.arange(len(self.hashes)) - np.repeat(self.first[:-1], np.diff(self.first))

    def fits(self, size: int) -> np.ndarray:
        """Whether `size` words from each word on stay in its text."""
        return np.arange(len(self.hashes)) + size <= np.repeat(self.first[1:], np.diff(self.first))

    def text(self, i: int) -> bytes:
        return bytes(self.data[self.offsets[i] : self.offsets[i + 1]])
