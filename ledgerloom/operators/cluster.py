"""K-Means sweep and cluster profiles.

All starts of all cluster counts share their passes over the rows. The starts are drawn by k-means++ over every row: in one
pass each row draws an exponential number divided by its squared distance from the centres chosen so far, and the smallest
draw of the table is the next centre of its start, so a start takes as many passes as its largest cluster count, whatever
the number of starts; smaller counts use its first centres. An iteration is one aggregate: tasks add up rows per (start,
count, cluster) of the sets that still move, and the driver sees the sums alone. The number of passes is that of the
longest run.

Defined cases: a row with a NULL or NaN feature takes no part and has no cluster; repeated rows draw the same number; with fewer
different rows than clusters some clusters stay empty; a table without rows raises ValueError.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.classify import Scaler
from ledgerloom.operators.profile import group_medians, modes
from ledgerloom.session import cut_lineage

# Tried cluster counts, iterations, first seed, largest move of a centre that stands still, rows of a matrix product.
KS, MAX_ITER, SEED, TOLERANCE, SLICE = (3, 4, 5), 500, 42, 1e-4, 2000


def _spread(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit changes half of the result."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, rows by centres."""
    return np.stack([((points - c) ** 2).sum(axis=1) for c in centres], axis=1)


def _assigned(sets: list[np.ndarray], first: np.ndarray):
    """Scan for `Sweep._sums`: cost of each set, then rows and sums of features per cluster, from place `first` on.

    Distances of a slice of rows from all centres are one matrix product, and so are the sums of its clusters.
    """
    alike: dict[int, list[int]] = {}
    for i, c in enumerate(sets):
        alike.setdefault(len(c), []).append(i)
    stacks = [(k, of, np.concatenate([sets[i] for i in of])) for k, of in alike.items()]
    halves = [(c**2).sum(axis=1)[:, None] / 2 for _, _, c in stacks]

    def scan(points, total):
        for begin in range(0, len(points), SLICE):
            rows = points[begin : begin + SLICE]
            square = float((rows**2).sum())
            for (k, of, centres), half in zip(stacks, halves):
                far = (half - centres @ rows.T).reshape(len(of), k, len(rows))  # half the squared distance, without the row's square
                least, near = far[:, 0].copy(), np.zeros((len(of), len(rows)), np.int16)
                for j in range(1, k):
                    closer = far[:, j] < least
                    near[closer] = j
                    np.minimum(least, far[:, j], out=least)
                own = (near[:, None] == np.arange(k, dtype=np.int16)[:, None]).astype(float)
                sums = (own.reshape(-1, len(rows)) @ rows).reshape(len(of), k, -1)
                sums = np.concatenate([own.sum(axis=2)[:, :, None], sums], axis=2)
                for i, cost, block in zip(of, least.sum(axis=1), sums):
                    total[first[i]] += square + 2 * cost
                    total[first[i] + 1 : first[i] + 1 + block.size] += block.ravel()

    return scan


def _points(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return np.column_stack([batch.column(f"x{i}").to_numpy(zero_copy_only=False).astype(float) for i in range(width)])


class Sweep:
    """Stacked centre sets over a written table (features x0 .., draw hash `u`)."""

    def __init__(self, rows: DataFrame, width: int, seed: int):
        self.rows, self.width, self.seed = rows, width, seed
        self.passes = 0

    def _sums(self, scan, size: int) -> np.ndarray:
        """One pass: cells that tasks add up with `scan(points, total)`, added up by Spark."""
        width = self.width

        def tasks(batches) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for batch in batches:
                scan(_points(batch, width), total)
            hit = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(total[hit])], names=["cell", "v"])

        self.passes += 1
        out = np.zeros(size)
        for cell, v in self.rows.mapInArrow(tasks, "cell int, v double").groupBy("cell").agg(F.sum("v")).collect():
            out[cell] = v
        return out

    def starts(self, count: int, most: int) -> np.ndarray:
        """`most` centres for each of `count` starts: count x most x width."""
        chosen = np.zeros((count, 0, self.width))
        for step in range(most):
            picked = {r["start"]: r["at"]["x"] for r in self._drawn(chosen, step).collect()}  # a row per start
            if step == 0 and not picked:
                raise ValueError("no rows to cluster")
            new = np.array([picked.get(s, chosen[s, 0] if step else None) for s in range(count)], float)
            chosen = np.concatenate([chosen, new[:, None]], axis=1)
        return chosen

    def _drawn(self, chosen: np.ndarray, step: int) -> DataFrame:
        width, count = self.width, len(chosen)
        salts = [_spread(np.array([self.seed + 1000003 * s + 7919 * step], np.uint64) + np.uint64(1))[0] for s in range(count)]

        def tasks(batches) -> Iterator[pa.RecordBatch]:
            best = [(np.inf, None)] * count
            for batch in batches:
                points, u = _points(batch, width), batch.column("u").to_numpy().view(np.uint64)
                for s in range(count):
                    far = _distances(points, chosen[s]).min(axis=1) if step else np.ones(len(points))
                    draw = (_spread(u ^ salts[s]) >> np.uint64(11)).astype(float) + 0.5
                    with np.errstate(divide="ignore"):
                        wait = -np.log(draw / 2.0**53) / far
                    i = int(wait.argmin()) if len(wait) else 0
                    if len(wait) and wait[i] < best[s][0]:
                        best[s] = (float(wait[i]), points[i].tolist())
            held = [(s, w, x) for s, (w, x) in enumerate(best) if x is not None]
            columns = zip(*held) if held else ([], [], [])
            types = (pa.int32(), pa.float64(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["start", "wait", "x"])

        self.passes += 1
        found = self.rows.mapInArrow(tasks, "start int, wait double, x array<double>")
        return found.groupBy("start").agg(F.min(F.struct("wait", "x")).alias("at"))

    def run(self, sets: list[np.ndarray], max_iter: int, tolerance: float) -> list[float]:
        """Lloyd's iterations of all sets, in place; cost of each at the last pass it took part in."""
        cost = [np.inf] * len(sets)
        live = list(range(len(sets)))
        for _ in range(max_iter):
            if not live:
                break
            at = [sets[i] for i in live]
            first = np.cumsum([0] + [len(c) * (self.width + 1) + 1 for c in at])
            found = self._sums(_assigned(at, first), int(first[-1]))
            moving = []
            for i, start in zip(live, first):
                old = sets[i]
                cost[i] = float(found[start])
                block = found[start + 1 : start + 1 + old.size + len(old)].reshape(len(old), -1)
                sets[i] = np.where(block[:, :1] > 0, block[:, 1:] / np.maximum(block[:, :1], 1), old)
                if np.sqrt(((sets[i] - old) ** 2).sum(axis=1)).max() > tolerance:
                    moving.append(i)
            live = moving
        return cost

    def judged(self, sets: list[np.ndarray]) -> list[tuple[float, float]]:
        """(silhouette, inertia) of each set, all in two passes; the silhouette uses squared Euclidean distance."""
        width = self.width
        first = np.cumsum([0] + [len(c) * (width + 2) + 1 for c in sets])

        def count(points, total):
            squares = (points**2).sum(axis=1)
            for c, start in zip(sets, first):
                far = _distances(points, c)
                near = far.argmin(axis=1)
                total[start] += far.min(axis=1).sum()
                block = total[start + 1 : start + 1 + len(c) * (width + 2)].reshape(len(c), -1)
                block[:, 0] += np.bincount(near, minlength=len(c))
                block[:, 1] += np.bincount(near, squares, len(c))
                for j in range(width):
                    block[:, j + 2] += np.bincount(near, points[:, j], len(c))

        sums = self._sums(count, int(first[-1]))
        blocks = [sums[a + 1 : b].reshape(len(c), -1) for c, a, b in zip(sets, first, first[1:])]

        def compare(points, total):
            squares = (points**2).sum(axis=1)[:, None]
            for i, (c, block) in enumerate(zip(sets, blocks)):
                n = np.maximum(block[:, 0], 1)
                mean = squares + block[:, 1] / n - 2 * points @ block[:, 2:].T / n  # to all rows of a cluster
                mean[:, block[:, 0] == 0] = np.inf
                near = _distances(points, c).argmin(axis=1)
                rows = np.arange(len(points))
                own = mean[rows, near] * n[near] / np.maximum(n[near] - 1, 1)
                mean[rows, near] = np.inf
                other = mean.min(axis=1)
                alone = (n[near] == 1) | np.isinf(other)
                with np.errstate(invalid="ignore", divide="ignore"):
                    value = np.where(alone | (np.maximum(own, other) == 0), 0.0, (other - own) / np.maximum(own, other))
                total[i] += value.sum()

        inside = self._sums(compare, len(sets))
        return [(float(s / b[:, 0].sum()), float(sums[a])) for s, b, a in zip(inside, blocks, first)]


def sweep(df: DataFrame, features: Sequence[str], keep: Sequence[str], ks: Sequence[int] = KS, starts: int = 20, seed: int = SEED):
    """(table, rows): per K the best of several starts by cost, with its silhouette; rows carry `cluster_k<K>`.

    The silhouette uses squared Euclidean distance, computed from cluster sums in linear time; the plain Euclidean
    one would need all pairs of rows.
    """
    scaled = Scaler.fit(df, features).apply(df)
    x = [F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)]
    draw = F.xxhash64(*keep, *features).alias("u")
    written = cut_lineage(scaled.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], *x, draw))
    names = [f"x{i}" for i in range(len(features))]
    complete = written.dropna(subset=names)  # NaN counts as missing, too
    job = Sweep(complete.select(*names, "u"), len(features), seed)
    first = job.starts(starts, max(ks))
    sets = [first[s, :k].copy() for k in ks for s in range(starts)]
    cost = job.run(sets, MAX_ITER, TOLERANCE)
    best = [sets[min(range(i * starts, (i + 1) * starts), key=cost.__getitem__)] for i in range(len(ks))]
    found = [(k, *judged) for k, judged in zip(ks, job.judged(best))]
    top = max(found, key=lambda r: r[1])[0]
    table = df.sparkSession.createDataFrame([(*r, r[0] == top) for r in found], "k int, silhouette double, inertia double, is_best boolean")

    def place(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _points(batch, len(features))
            lost = np.isnan(points).any(axis=1)
            clusters = [pa.array(_distances(points, c).argmin(axis=1).astype(np.int32), mask=lost) for c in best]
            kept = [batch.column(f"k{i}") for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays(kept + clusters, names=[*keep, *[f"cluster_k{k}" for k in ks]])

    schema = df.select(*keep).schema
    for k in ks:
        schema = schema.add(f"cluster_k{k}", "integer")
    return table, written.mapInArrow(place, schema)


def cluster_profile(df: DataFrame, cluster: str, label: str, labels: Sequence[str], medians: Sequence[str], category: str) -> DataFrame:
    """Size, share of each label in percent, medians, and the most frequent category per cluster."""
    shares = [(F.avg(F.coalesce((F.col(label) == v).cast("double"), F.lit(0.0))) * 100).alias(f"pct_{v.lower()}") for v in labels]
    sizes = df.groupBy(cluster).agg(F.count("*").alias("n"), *shares)
    middle = group_medians(df, cluster, medians)
    return sizes.join(middle, cluster, "left").join(modes(df, [cluster], category, f"mode_{category}"), cluster, "left")
