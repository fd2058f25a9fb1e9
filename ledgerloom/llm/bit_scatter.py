"""Whitening of embeddings from exact, bit-sliced cross-products.

Each component c becomes the integer x = floor(scale c) + offset. Within a slab of rows every dimension is shifted by its smallest
value and cut into bit planes, each packed across the rows into 64-bit words. The number of rows that have bit b of
dimension i and bit c of dimension j is one AND and popcount of two word rows; weighted by 2^(b+c) and summed over the
planes these are the exact cross-products of the shifted integers, and adding the shifts back gives those of x. Tasks add
up their slabs in whole numbers and send d (d + 1) / 2 sums for d dimensions, which Spark adds; the driver receives one
number per pair of dimensions, whatever the number of rows. The scatter n * sum(x_i x_j) - S_i S_j is centred as integers
and only then divided and given to eigh.

A second pass projects n x - S, a whole number too, on the components, and a third one measures the covariance
of the result.

Defined cases: rows whose vector is null, or holds a null or non-finite component, take no part, nor do those whose length is not
the most frequent one (ties to the shorter) and those with a component of which scale c is 2^53 or more, where doubles no longer tell
integers apart. A zero vector and a row without an id take part; repeated rows count as often as they occur. Components whose
variance is numerically zero (not above d eps times the largest; a single or constant vector has only such) have a
null `whitened` value and take no part in the error; `explained` is null if all variance is zero. `deviation` has up to 38
digits and is null beyond. An empty table gives an empty result; other columns are ignored, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.storage import saved

SCALE, OFFSET = 1024, 100000
SLAB = 1 << 14  # rows packed at a time
WHOLE = float(2**53)
ONES = -1  # in the table of sums: the constant 1 as a dimension, so (ONES, i) is a sum and (ONES, ONES) the count


def usable(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v) of the vectors that take part."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), v.alias("v")).filter("v is not null")
    rows = rows.filter(F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c * scale) < WHOLE), F.lit(False))))
    size = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return rows.filter(F.size("v") == (size["size"] if size else 0)).filter(F.size("v") > 0)


def whole(column: pa.Array, scale: int, offset: int) -> np.ndarray:
    """The integers of a list column, one row per vector."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return (np.floor(scale * flat).astype(np.int64) + offset).reshape(len(column), -1)


def planes(shifted: np.ndarray) -> np.ndarray:
    """Bit planes of non-negative integers (rows x d) as words across the rows: d x bits x words."""
    rows, d = shifted.shape
    bits = max(1, int(shifted.max(initial=0)).bit_length())
    out = np.zeros((d, bits, -(-rows // 64)), np.uint64)
    for b in range(bits):
        packed = np.packbits(((shifted >> b) & 1).astype(bool), axis=0, bitorder="little").T
        padded = np.zeros((d, out.shape[2] * 8), np.uint8)
        padded[:, : packed.shape[1]] = packed
        out[:, b] = padded.view(np.uint64)
    return out


def weighted_popcounts(words: np.ndarray) -> np.ndarray:
    """Exact sum of products of every pair of dimensions (d x d Python integers) from their bit planes."""
    d, bits, n = words.shape
    flat = words.reshape(d * bits, n)
    count = np.zeros((d * bits, d * bits), np.int64)
    for i in range(d * bits):
        count[i, i:] = np.bitwise_count(flat[i] & flat[i:]).sum(axis=1, dtype=np.int64)
    count = np.maximum(count, count.T).reshape(d, bits, d, bits)
    total = np.zeros((d, d), object)
    for s in range(2 * bits - 1):  # all plane pairs of one weight at once
        pairs = sum(count[:, b, :, s - b] for b in range(max(0, s - bits + 1), min(s, bits - 1) + 1))
        total += pairs.astype(object) * 2**s
    return total


def scatter(x: np.ndarray) -> np.ndarray:
    """Cross-products of the columns of x and of a column of ones in front of them, as Python integers."""
    rows, d = x.shape
    shift = x.min(axis=0)
    words = planes(x - shift)
    products = weighted_popcounts(words)
    shift = shift.astype(object)
    weights = 2 ** np.arange(words.shape[1]).astype(object)
    sums = (np.bitwise_count(words).sum(axis=2, dtype=np.int64).astype(object) * weights).sum(axis=1)
    out = np.empty((d + 1, d + 1), object)
    out[0, 0] = rows
    out[0, 1:] = out[1:, 0] = sums + rows * shift
    out[1:, 1:] = products + np.outer(shift, sums) + np.outer(sums, shift) + rows * np.outer(shift, shift)
    return out


def cross_products(rows: DataFrame, scale: int, offset: int) -> DataFrame:
    """(i, j, total) for i <= j over all rows; dimension -1 is the constant 1."""

    def scan(batches):
        total = None
        for batch in batches:
            x = whole(batch.column("v"), scale, offset)
            for start in range(0, len(x), SLAB):
                part = scatter(x[start : start + SLAB])
                total = part if total is None else total + part
        if total is not None:
            i, j = np.triu_indices(len(total))
            # two halves of each sum: a task's total may have more digits than a decimal
            values = total[i, j]
            yield pa.RecordBatch.from_arrays(
                [pa.array(i + ONES, pa.int32()), pa.array(j + ONES, pa.int32())]
                + [pa.array(v.astype(np.int64)) for v in (values & (2**31 - 1), (values >> 31) & (2**31 - 1), (values >> 62) & (2**31 - 1))]
                + [pa.array((values >> 93).astype(np.int64))],
                names=["i", "j", "p0", "p1", "p2", "p3"],
            )

    parts = rows.select("v").mapInArrow(scan, "i int, j int, p0 bigint, p1 bigint, p2 bigint, p3 bigint")
    return parts.groupBy("i", "j").agg(*[F.sum(p).alias(p) for p in ("p0", "p1", "p2", "p3")])


@dataclass(frozen=True)
class Whitening:
    """`rows` is n, `sums` the S of each dimension, `scatter` n^2 times the covariance, exact; eigenvalues fall."""

    rows: int
    sums: np.ndarray
    scatter: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @property
    def used(self) -> np.ndarray:
        """Whether a component has variance beyond rounding."""
        d = len(self.values)
        return self.values > d * np.finfo(float).eps * max(self.values[0], 0.0)

    def explained(self) -> np.ndarray | None:
        """Share of each component in all variance."""
        trace = sum(self.scatter[i, i] for i in range(len(self.sums)))
        return np.maximum(self.values, 0.0) / (trace / self.rows**2) if trace else None


def fit(rows: DataFrame, scale: int = SCALE, offset: int = OFFSET) -> Whitening | None:
    """Whitening of usable rows; None if there is none."""
    found = cross_products(rows, scale, offset).collect()  # one row per pair of dimensions
    if not found:
        return None
    d = max(r["j"] for r in found) + 1
    total = np.zeros((d + 1, d + 1), object)
    for r in found:
        value = sum(r[f"p{k}"] << 31 * k for k in range(4))
        total[r["i"] - ONES, r["j"] - ONES] = total[r["j"] - ONES, r["i"] - ONES] = value
    n, sums = total[0, 0], total[0, 1:]
    centred = n * total[1:, 1:] - np.outer(sums, sums)
    covariance = np.array([[value / n**2 for value in row] for row in centred], float)  # Python divides integers exactly
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1].copy(), vectors[:, ::-1].copy()
    top = np.abs(vectors).argmax(axis=0)
    vectors *= np.sign(vectors[top, np.arange(d)])  # the largest entry of a component is positive
    return Whitening(n, sums, centred, values, vectors)


def project(rows: DataFrame, model: Whitening, components: int = 8, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """(id, deviation, w): squared distance of n x from S, exact, and the whitened components of each row (null ones in place)."""
    d = len(model.sums)
    k = min(components, d)
    used = model.used[:k]
    axes = model.vectors[:, :k][:, used] / np.sqrt(model.values[:k][used])
    n, sums = model.rows, model.sums
    place = np.full(k, -1)
    place[used] = np.arange(used.sum())

    def deviations(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        peak = int(np.abs(x).max(initial=0)) * n + max(abs(s) for s in sums)
        far = n * x - sums.astype(np.int64) if peak < 2**63 else n * x.astype(object) - sums
        widest = int(np.abs(far).max(initial=0))
        exact = far if d * widest * widest < 2**63 else far.astype(object)
        return far, (exact * exact).sum(axis=1)

    def scan(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far, squares = deviations(whole(batch.column("v"), scale, offset))
            w = far.astype(float) / n @ axes
            cells = np.concatenate([w, np.full((len(w), 1), np.nan)], axis=1)[:, place]
            flat = pa.array(cells.ravel(), mask=np.tile(~used, len(w)))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, cells.size + 1, k), pa.int32()), flat)
            digits = pa.array([int(s) if s < 10**38 else None for s in squares], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([batch.column("id"), digits, lists], names=["id", "deviation", "w"])

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(scan, f"id {id_type}, deviation decimal(38,0), w array<double>")


def identity_error(projected: DataFrame, used: list[int]) -> float | None:
    """Largest entry of the measured covariance of the whitened components minus the identity."""
    w = {i: F.col("w")[i] for i in used}
    pairs = [(i, j) for i in used for j in used if i <= j]
    if not pairs:
        return None
    row = projected.agg(*[F.covar_pop(w[i], w[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(row[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = 8,
    scale: int = SCALE,
    offset: int = OFFSET,
) -> DataFrame:
    """One row per usable vector and component: id, component (from 1), n, deviation, whitened, explained, identity_error."""
    rows = usable(vectors, id_col, vector_col, scale)
    model = fit(rows, scale, offset)
    id_type = rows.schema["id"].dataType.simpleString()
    if model is None:
        empty = f"id {id_type}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], empty)
    projected = saved(project(rows, model, components, scale, offset), "whitened")
    k = min(components, len(model.sums))
    error = identity_error(projected, [i for i in range(k) if model.used[i]])
    shares = model.explained()
    number = lambda v: F.lit(None if v is None else float(v)).cast("double")
    share = F.array(*[number(None if shares is None else shares[i]) for i in range(k)])
    return projected.select("id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        "id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.rows).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(share, F.col("at")).alias("explained"),
        number(error).alias("identity_error"),
    )
