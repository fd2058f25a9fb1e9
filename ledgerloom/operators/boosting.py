"""Second-order gradient boosting of trees for a 0/1 label: regularised gains from histograms that Spark adds up.

Features are cut into at most `bins` bins at quantiles of the whole table (one aggregate), and the binned rows are written
once. A level of a tree is one aggregate: tasks add up gradient, curvature and count of their rows per (node, feature,
bin), Spark adds the tasks' histograms, and only these reach the driver, whatever the number of rows. A tree of depth D takes
at most D passes. Rows keep the margin of finished trees; it is written anew every `carry` rounds, so a pass never
evaluates more than `carry` trees.

A split wins by 1/2 (GL^2 / (HL + l2) + GR^2 / (HR + l2) - G^2 / (H + l2)) - gamma, both sides holding rows and at least
`min_curvature`; ties go to the earlier feature, then the lower cut. A leaf adds -rate G / (H + l2) to the margin.

Defined cases: rows with a NULL label take no part; NULL and NaN features form their own bin, which each split sends to the side
with the larger gain (right if equal), also when no such row was seen; a constant feature is never split; a table with one
class or no rows has trees of a single leaf, or none.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.logit import sigmoid
from ledgerloom.session import cut_lineage

# Rounds, depth, learning rate, L2 penalty, least gain, least curvature of a side, bins.
ROUNDS, DEPTH, RATE, L2, GAMMA, MIN_CURVATURE, BINS = 100, 6, 0.3, 1.0, 0.0, 1.0, 256
CARRY = 10  # rounds between two writings of the margins


@dataclass
class Tree:
    """Nodes as lists; `feature` is -1 in a leaf. Rows whose bin is at most `cut` go left, bin -1 (missing) as `missing_left` says."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [-1])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [-1])
    weight: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, missing_left: bool, gain: float, weights: tuple[float, float]) -> tuple[int, int]:
        """Turn a leaf into an inner node; the right child follows the left one."""
        left = len(self.feature)
        self.feature[node], self.cut[node], self.missing_left[node], self.left[node], self.gain[node] = feature, cut, missing_left, left, gain
        for w in weights:
            for column, value in zip((self.feature, self.cut, self.missing_left, self.left, self.weight, self.gain), (-1, -1, False, -1, w, 0.0)):
                column.append(value)
        return left, left + 1

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """Leaf of every row of a matrix of bins."""
        feature, cut, left, missing = (np.array(c) for c in (self.feature, self.cut, self.left, self.missing_left))
        at = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins))
        while True:
            rows = rows[feature[at[rows]] >= 0]
            if not len(rows):
                return at
            here = at[rows]
            value = bins[rows, feature[here]]
            go_left = np.where(value < 0, missing[here], value <= cut[here])
            at[rows] = left[here] + np.where(go_left, 0, 1)


@dataclass
class Boosted:
    features: list[str]
    cuts: list[np.ndarray]  # ascending per feature; bin i holds the values above cut i - 1 and up to cut i
    rate: float
    trees: list[Tree] = field(default_factory=list)

    def binned(self, values: np.ndarray) -> np.ndarray:
        out = np.empty(values.shape, np.int16)
        for i, cuts in enumerate(self.cuts):
            column = values[:, i]
            out[:, i] = np.where(np.isnan(column), -1, np.searchsorted(cuts, column, side="left"))
        return out

    def margin(self, bins: np.ndarray, trees: Sequence[Tree] | None = None) -> np.ndarray:
        out = np.zeros(len(bins))
        for tree in self.trees if trees is None else trees:
            out += np.array(tree.weight)[tree.nodes(bins)]
        return out

    def predict(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """keep columns + prediction (0/1) + score (probability of class 1)."""
        names = [f"_f{i}" for i in range(len(self.features))]
        rows = df.select(*keep, *[F.col(f).cast("double").alias(n) for f, n in zip(self.features, names)])

        def scan(batches) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                score = sigmoid(self.margin(self.binned(_matrix(batch, names))))
                columns = [batch.column(k) for k in keep] + [pa.array((score > 0.5).astype(np.int32)), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "prediction", "score"])

        schema = df.select(*keep).schema.add("prediction", "integer").add("score", "double")
        return rows.mapInArrow(scan, schema)

    def importance(self) -> dict[str, float]:
        """Share of each feature in all gain."""
        total = {f: 0.0 for f in self.features}
        for tree in self.trees:
            for feature, gain in zip(tree.feature, tree.gain):
                if feature >= 0:
                    total[self.features[feature]] += gain
        whole = sum(total.values())
        return {f: g / whole if whole else 0.0 for f, g in total.items()}


def _matrix(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    """Columns as doubles, NULL as NaN."""
    return np.column_stack([batch.column(n).to_numpy(zero_copy_only=False).astype(float) for n in names]) if names else np.zeros((batch.num_rows, 0))


def quantile_cuts(df: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """At most bins - 1 cuts per feature, all features in one aggregate; few distinct values are cut exactly."""
    at = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    value = lambda f: F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double"))
    row = df.agg(*[F.percentile_approx(value(f), at, 20 * bins).alias(f"c{i}") for i, f in enumerate(features)]).first()
    return [np.unique(np.array(row[f"c{i}"] or [], float)) for i in range(len(features))]


def boost(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    rounds: int = ROUNDS,
    depth: int = DEPTH,
    rate: float = RATE,
    l2: float = L2,
    gamma: float = GAMMA,
    min_curvature: float = MIN_CURVATURE,
    bins: int = BINS,
    carry: int = CARRY,
) -> Boosted:
    """Fit `rounds` trees; passes over the binned rows are at most rounds x depth, plus one per `carry` rounds."""
    if not 2 <= bins <= 2**15:
        raise ValueError("bins from 2 to 32768")
    df = df.filter(F.col(label).isNotNull())
    model = Boosted(list(features), quantile_cuts(df, features, bins), rate)
    names = [f"f{i}" for i in range(len(model.features))]
    raw = df.select(F.col(label).cast("double").alias("y"), *[F.col(f).cast("double").alias(n) for f, n in zip(features, names)])

    def bin_rows(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _packed(batch.column("y"), np.zeros(batch.num_rows), model.binned(_matrix(batch, names)))

    schema = "y double, margin double, bins array<smallint>"
    rows = cut_lineage(raw.mapInArrow(bin_rows, schema))
    fresh: list[Tree] = []  # trees that are not in the written margins yet
    for done in range(rounds):
        tree = Tree()
        active = [0]
        for _ in range(depth):
            if not active:
                break
            found = _histograms(rows, model, fresh, tree, active)
            active = _grow(tree, active, found, rate, l2, gamma, min_curvature)
        model.trees.append(tree)
        fresh.append(tree)
        if len(fresh) == carry and done + 1 < rounds:
            rows = cut_lineage(rows.mapInArrow(_carried(model, fresh), schema))
            fresh = []
    return model


def _packed(y: pa.Array, margin: np.ndarray, bins: np.ndarray) -> pa.RecordBatch:
    width = bins.shape[1]
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(bins) + 1) * width, pa.int32()), pa.array(bins.ravel(), pa.int16()))
    return pa.RecordBatch.from_arrays([y, pa.array(margin, pa.float64()), lists], names=["y", "margin", "bins"])


def _unpacked(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    bins = batch.column("bins").flatten().to_numpy().reshape(batch.num_rows, width)
    return batch.column("margin").to_numpy(), bins


def _carried(model: Boosted, fresh: Sequence[Tree]):
    trees, width = list(fresh), len(model.features)

    def scan(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin, bins = _unpacked(batch, width)
            yield _packed(batch.column("y"), margin + model.margin(bins, trees), bins)

    return scan


def _histograms(rows: DataFrame, model: Boosted, fresh: Sequence[Tree], tree: Tree, active: Sequence[int]) -> np.ndarray:
    """Gradient, curvature and count per (active node, feature, bin), bin 0 for missing values: one aggregate."""
    width, deep = len(model.features), max((len(c) for c in model.cuts), default=0) + 2
    shape = (len(active), width, deep)
    place = np.full(len(tree.feature), -1)
    place[list(active)] = np.arange(len(active))
    trees = list(fresh)

    def scan(batches) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, int(np.prod(shape))))
        for batch in batches:
            margin, bins = _unpacked(batch, width)
            node = place[tree.nodes(bins)]
            use = node >= 0
            p = sigmoid((margin + model.margin(bins, trees))[use])
            gradient = p - batch.column("y").to_numpy()[use]
            cell = ((node[use][:, None] * width + np.arange(width)) * deep + bins[use] + 1).ravel()
            for i, v in enumerate((gradient, p * (1 - p), np.ones(len(p)))):
                total[i] += np.bincount(cell, np.repeat(v, width), total.shape[1])
        hit = np.flatnonzero(total[2])
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), *[pa.array(t[hit]) for t in total]], names=["cell", "g", "h", "n"])

    parts = rows.mapInArrow(scan, "cell int, g double, h double, n double")
    out = np.zeros((3, int(np.prod(shape))))
    for r in parts.groupBy("cell").agg(F.sum("g"), F.sum("h"), F.sum("n")).collect():  # the histogram
        out[:, r[0]] = r[1:]
    return out.reshape(3, *shape)


def _grow(tree: Tree, active: Sequence[int], found: np.ndarray, rate: float, l2: float, gamma: float, least: float) -> list[int]:
    """Split the active nodes where it gains; returns the new leaves."""
    value = lambda g, h: g * g / (h + l2)
    new: list[int] = []
    for i, node in enumerate(active):
        g, h, n = found[:, i]
        whole = [float(a[0].sum()) for a in (g, h, n)] if len(g) else [0.0, 0.0, 0.0]
        if not whole[2]:
            continue
        if node == 0:
            tree.weight[0] = -rate * whole[0] / (whole[1] + l2)
        sides = []
        for missing in (0, 1):  # missing values right, then left
            left = [a[:, 1:].cumsum(axis=1) + missing * a[:, :1] for a in (g, h, n)]
            right = [w - a for w, a in zip(whole, left)]
            with np.errstate(invalid="ignore", divide="ignore"):
                gain = 0.5 * (value(left[0], left[1]) + value(right[0], right[1]) - value(whole[0], whole[1])) - gamma
            held = (left[2] > 0.5) & (right[2] > 0.5) & (left[1] >= least) & (right[1] >= least)
            sides.append((np.where(held, gain, -np.inf), left, right))
        tops = [float(s[0].max(initial=-np.inf)) for s in sides]
        missing = int(tops[1] > tops[0])
        gain, left, right = sides[missing]
        if tops[missing] <= 1e-12:
            continue
        feature, cut = (int(v) for v in np.unravel_index(gain.argmax(), gain.shape))
        weights = tuple(-rate * float(s[0][feature, cut]) / (float(s[1][feature, cut]) + l2) for s in (left, right))
        new += tree.split(node, feature, cut, bool(missing), tops[missing], weights)
    return new
