"""Random forest whose rows and nodes stay in tables: the driver sees the upper nodes and sums per feature alone.

Features are cut into at most 32 bins, between all neighbouring values where there are no more than 32 and else near quantiles
of all rows, and the binned rows are written once. Every tree draws each row a Poisson(1) number of times by a hash
of the row's number. Nodes of more than `GROUP` drawn rows are split level by level: tasks add up counts per (node,
feature, bin, class), groups of one node add the tasks' counts and keep the best cut. A smaller node gets its rows once, packed by
task, and one group grows it to its end. Its subtree is one row of a written table. For predictions, rows go to the
subtrees they fall into, and votes are added up per row as integers, so the order of adding does not matter.

A node tries ceil(sqrt(features)) features drawn for it; the largest Gini gain wins, ties go to the earlier feature, then the
lower cut. Nodes of one class or at the greatest depth are leaves, and leaves below one node that agree in their
class become one. A leaf votes with its shares of the classes, weighted by class.

Defined cases: NULL and NaN features and labels raise errors, as do labels other than 0, 1, .. 99 and tables without rows.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.boosting import quantile_cuts
from ledgerloom.session import cut_lineage, shared_folder

# Bins of a feature, rows of a node that one group grows, upper nodes of one pass, nodes split at a time, classes.
BINS, GROUP, NODES, CHUNK, CLASSES = 32, 100_000, 4096, 4096, 100
LEAST_GAIN = 1e-15
VOTE = 2.0**40  # votes are counted in units of 1 / VOTE
PARTS = 1000  # most partitions of the groups
# Chance of at most 0, 1, 2, .. draws.
DRAWS = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 12)]))
INTS, REALS = pa.list_(pa.int32()), pa.list_(pa.float64())
ARROW = {"feature": INTS, "cut": INTS, "left": INTS, "count": pa.list_(pa.int64()), "gain": REALS, "stats": REALS, "weight": REALS, "node": pa.int32(), "tree": pa.int32(), "top": pa.int32()}
NAMES = {INTS: "array<int>", REALS: "array<double>", pa.list_(pa.int64()): "array<bigint>", pa.int32(): "int"}
SUBTREE = ", ".join(f"{c} {NAMES[t]}" for c, t in ARROW.items())
COLUMNS = ("feature", "cut", "left", "count", "gain", "stats")


def _spread(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit changes half of the result."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _drawn(ids: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often the tree draws each row: Poisson with mean 1."""
    salt = _spread(np.array([seed * 1_000_003 + tree + 1], np.uint64))[0]
    u = (_spread(_spread(ids.view(np.uint64) + np.uint64(1)) ^ salt) >> np.uint64(11)).astype(float) / 2.0**53
    return np.searchsorted(DRAWS, u, side="right").astype(np.uint8)


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1) if rows else np.zeros((0, 1))


def _packed(blobs: Sequence[np.ndarray]) -> pa.Array:
    return pa.array([b.tobytes() for b in blobs], pa.binary())


def _unpacked(column: pa.ChunkedArray, dtype, width: int) -> np.ndarray:
    return np.concatenate([np.frombuffer(b.as_buffer(), dtype) for b in column]).reshape(-1, width)


def _subsets(rng: np.random.Generator, nodes: int, width: int, tried: int) -> np.ndarray:
    """Ascending features that each node tries."""
    return np.sort(rng.random((nodes, width)).argsort(axis=1)[:, :tried], axis=1)


def best_cut(counts: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gain, bin) of the best cut of each node from its counts, nodes by bins by classes; gain 0 where none gains.

    Only bins that hold rows are weighed: a level of small nodes has far more bins than rows.
    """
    nodes, bins, classes = counts.shape
    won, at = np.zeros(nodes), np.zeros(nodes, np.int64)
    flat = counts.reshape(-1, classes)
    cell = np.flatnonzero(sum(flat[:, k] for k in range(classes)))
    if not len(cell):
        return won, at
    first = np.flatnonzero(np.diff(cell // bins, prepend=-1))  # first cell of each node that has rows
    size = np.diff(first, append=len(cell))
    last = first + size - 1
    run = flat[cell].cumsum(axis=0)
    before = run[first] - flat[cell[first]]
    left = run - before.repeat(size, axis=0)
    whole = run[last] - before
    right = whole.repeat(size, axis=0) - left
    squares = lambda a: np.divide((a**2).sum(axis=1), a.sum(axis=1), out=np.zeros(len(a)), where=a.any(axis=1))
    left, right, whole = left * weights, right * weights, whole * weights
    gain = (squares(left) + squares(right) - squares(whole).repeat(size)) / np.maximum(whole.sum(axis=1), 1e-300).repeat(size)
    gain[last] = 0.0  # nothing is left on the right
    gain = np.where(gain > LEAST_GAIN, gain, 0.0)
    best = np.maximum.reduceat(gain, first)
    hit = np.flatnonzero(gain == best.repeat(size))
    place = hit[np.searchsorted(hit, first)]
    node = cell[first] // bins
    won[node], at[node] = best, np.where(best > 0, cell[place] % bins, 0)
    return won, at


@dataclass
class Nodes:
    """Nodes as columns; `feature` and `left` are -1 in a leaf, the right child follows the left one."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    count: np.ndarray  # rows, drawn ones as often as drawn
    gain: np.ndarray
    stats: np.ndarray  # weighted rows per class

    def leaves(self, bins: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Leaf of every row that starts at node `at`."""
        at, rows = at.copy(), np.arange(len(bins))
        while True:
            rows = rows[self.feature[at[rows]] >= 0]
            if not len(rows):
                return at
            here = at[rows]
            at[rows] = self.left[here] + (bins[rows, self.feature[here]] > self.cut[here])

    def join(self, given: np.ndarray | None = None) -> np.ndarray:
        """Turn nodes whose leaves agree into leaves; class of each node's leaves, -1 where they differ.

        `given` holds the class of every leaf, -1 for one that goes on in a subtree. Children come after their parents.
        """
        agreed = self.stats.argmax(axis=1) if given is None else given.copy()
        for node in np.flatnonzero(self.feature >= 0)[::-1]:
            a, b = agreed[self.left[node]], agreed[self.left[node] + 1]
            agreed[node] = a if a == b else -1
            if a == b and a >= 0:
                self.feature[node] = self.left[node] = -1
                self.gain[node] = 0.0
        return agreed

    def reached(self) -> Nodes:
        """Without the nodes below joined leaves."""
        inner = self.feature >= 0
        here = np.zeros(len(inner), bool)
        here[0] = True
        here[self.left[inner]] = here[self.left[inner] + 1] = True
        number = here.cumsum() - 1
        left = np.where(inner, number[self.left], -1)
        return Nodes(*[(left if c == "left" else getattr(self, c))[here] for c in COLUMNS])

    def shares(self) -> np.ndarray:
        return self.stats / self.stats.sum(axis=1, keepdims=True)

    def importance(self, width: int) -> np.ndarray:
        inner = self.feature >= 0
        return np.bincount(self.feature[inner], (self.gain * self.stats.sum(axis=1))[inner], width)


def grow(bins: np.ndarray, y: np.ndarray, drawn: np.ndarray, depth: int, tried: int, weights: np.ndarray, rng: np.random.Generator) -> Nodes:
    """The whole subtree of the given rows, at most `depth` levels below its root, before leaves are joined."""
    classes, width = len(weights), bins.shape[1]
    node = np.zeros(len(bins), np.int64)  # place in the level
    size, start, levels = 1, 0, []
    for level in range(depth + 1):
        counts = np.bincount(node * classes + y, drawn, size * classes).reshape(size, classes)
        feature, cut, left, gain = np.full(size, -1), np.zeros(size, np.int64), np.full(size, -1), np.zeros(size)
        levels.append((feature, cut, left, counts.sum(axis=1).astype(np.int64), gain, counts * weights))
        mixed = np.flatnonzero((counts > 0).sum(axis=1) > 1) if level < depth else np.zeros(0, np.int64)
        if not len(mixed):
            break
        place = np.full(size, -1)
        place[mixed] = np.arange(len(mixed))
        use = place[node] >= 0
        bins, y, drawn, node = bins[use], y[use], drawn[use], place[node[use]]
        if len(mixed) > CHUNK:
            order = node.argsort(kind="stable")
            bins, y, drawn, node = bins[order], y[order], drawn[order], node[order]
        for first in range(0, len(mixed), CHUNK):
            here = mixed[first : first + CHUNK]
            rows = slice(*np.searchsorted(node, [first, first + len(here)])) if len(mixed) > CHUNK else slice(None)
            local = node[rows] - first
            subset = _subsets(rng, len(here), width, tried)
            flat, start_of = bins[rows].ravel(), np.arange(len(local)) * width
            for j in range(tried):
                value = flat[start_of + subset[local, j]]
                found = np.bincount((local * BINS + value) * classes + y[rows], drawn[rows], len(here) * BINS * classes)
                won, at = best_cut(found.reshape(len(here), BINS, classes), weights)
                better = won > gain[here]
                gain[here] = np.where(better, won, gain[here])
                cut[here] = np.where(better, at, cut[here])
                feature[here] = np.where(better, subset[:, j], feature[here])
        split = np.flatnonzero(feature >= 0)
        left[split] = start + size + 2 * np.arange(len(split))
        goes = feature[mixed[node]] >= 0
        bins, y, drawn, node = bins[goes], y[goes], drawn[goes], mixed[node[goes]]
        node = left[node] - start - size + (bins[np.arange(len(bins)), feature[node]] > cut[node])
        start, size = start + size, 2 * len(split)
        if not size:
            break
    return Nodes(*[np.concatenate(c) for c in zip(*levels)])


@dataclass
class Forest:
    """Upper nodes at the driver, subtrees of their leaves in a written table (`SUBTREE`)."""

    features: list[str]
    cuts: list[np.ndarray]
    weights: np.ndarray
    upper: Nodes
    tree: np.ndarray  # tree of every upper node; the first ones are the roots
    trees_count: int
    subtrees: DataFrame
    depth: int
    seed: int
    _spark_trees: list = field(default_factory=list)

    def predict(self, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
        """keep columns + prediction + score (probability of class 1) of assembled rows."""
        upper, count, classes = self.upper, self.trees_count, len(self.weights)
        written = _binned(rows, self.cuts, keep)
        width = len(self.cuts)

        def deal(batches) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins, ids = _bins(batch, width), batch.column("id").to_numpy()
                for tree in range(count):
                    nodes, parts = _by_node(upper.leaves(bins, np.full(len(bins), tree)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(nodes, pa.int32()), _packed([bins[p] for p in parts]), _packed([ids[p] for p in parts])], names=["node", "bins", "ids"]
                    )

        def vote(rows, trees):
            if not rows.num_rows:
                return pa.table({"id": pa.array([], pa.int64()), **{f"v{k}": pa.array([], pa.int64()) for k in range(classes)}})
            found = _nodes(lambda c: trees.column(c)[0].values.to_numpy(zero_copy_only=False), classes)
            bins = _unpacked(rows.column("bins"), np.uint8, width)
            shares = found.shares()[found.leaves(bins, np.zeros(len(bins), np.int64))]
            votes = np.rint(shares * VOTE).astype(np.int64)
            return pa.table({"id": _unpacked(rows.column("ids"), np.int64, 1)[:, 0], **{f"v{k}": votes[:, k] for k in range(classes)}})

        parts = min(PARTS, max(1, int((upper.feature < 0).sum())))
        dealt = written.mapInArrow(deal, "node int, bins binary, ids binary").repartition(parts, "node")
        known = self.subtrees.select("node", *COLUMNS).repartition(parts, "node")
        schema = "id bigint, " + ", ".join(f"v{k} bigint" for k in range(classes))
        votes = dealt.groupBy("node").cogroup(known.groupBy("node")).applyInArrow(vote, schema)
        summed = votes.groupBy("id").agg(*[F.sum(f"v{k}").alias(f"v{k}") for k in range(classes)])
        most = F.greatest(*[F.col(f"v{k}") for k in range(classes)])
        prediction = F.coalesce(*[F.when(F.col(f"v{k}") == most, k) for k in range(classes)])
        total = sum((F.col(f"v{k}") for k in range(1, classes)), F.col("v0"))
        joined = written.join(summed, "id")
        scored = joined.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], prediction.cast("int").alias("prediction"), (F.col("v1") / total).alias("score"))
        return cut_lineage(scored)

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802 - the name that Spark's models use
        """Gain times weight per feature, each tree normalised, then the mean."""
        width = len(self.features)
        total = np.zeros((self.trees_count, width))
        inner = self.upper.feature >= 0
        np.add.at(total, (self.tree[inner], self.upper.feature[inner]), (self.upper.gain * self.upper.stats.sum(axis=1))[inner])
        sums = [F.sum(F.col("weight")[i]).alias(f"w{i}") for i in range(width)]
        for row in self.subtrees.groupBy("tree").agg(*sums).collect():  # a row per tree
            total[row["tree"]] += list(row[1:])
        whole = total.sum(axis=1, keepdims=True)
        shares = np.divide(total, whole, out=np.zeros_like(total), where=whole > 0).sum(axis=0)
        return DenseVector(shares / shares.sum() if shares.sum() else shares)

    @property
    def trees(self) -> list:
        """The trees as Spark's models. All nodes come to the driver: for looking at forests of few nodes."""
        if not self._spark_trees:
            self._spark_trees = self._exported().trees
        return self._spark_trees

    def _exported(self) -> RandomForestClassificationModel:
        spark, classes = self.subtrees.sparkSession, len(self.weights)
        below = {r["node"]: _nodes(r.__getitem__, classes) for r in self.subtrees.collect()}
        rows = []
        for tree in range(self.trees_count):
            # (nodes, place) in the order in which children follow their parents
            todo = [(self.upper, tree) if self.upper.feature[tree] >= 0 else (below[tree], 0)]
            for number, (nodes, at) in enumerate(todo):  # grows while it is read
                stats = nodes.stats[at]
                share = stats / stats.sum()
                head = (number, float(stats.argmax()), float(1 - (share**2).sum()), stats.tolist(), int(nodes.count[at]))
                if nodes.feature[at] < 0:
                    rows.append((tree, (*head, -1.0, -1, -1, (-1, [], -1))))
                    continue
                kids = [int(nodes.left[at]), int(nodes.left[at]) + 1]
                first = len(todo)
                todo += [(below[k], 0) if nodes is self.upper and nodes.feature[k] < 0 else (nodes, k) for k in kids]
                split = (int(nodes.feature[at]), [float(self.cuts[nodes.feature[at]][nodes.cut[at]])], -1)
                rows.append((tree, (*head, float(nodes.gain[at]), first, first + 1, split)))
        node = "id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double, leftChild: int, rightChild: int"
        split = "featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int"
        schema = f"treeID int, nodeData struct<{node}, split: struct<{split}>>"
        path = f"{shared_folder(spark)}/forest"
        base = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
        ml = "org.apache.spark.ml.classification"
        own = {"class": f"{ml}.RandomForestClassificationModel", "uid": f"forest_{self.seed}", "paramMap": {"maxDepth": self.depth, "numTrees": self.trees_count, "seed": self.seed}}
        plain = {"featuresCol": "features", "labelCol": "label", "predictionCol": "prediction", "probabilityCol": "probability", "rawPredictionCol": "rawPrediction", "leafCol": "", "impurity": "gini"}
        sizes = {"numFeatures": len(self.features), "numClasses": classes, "numTrees": self.trees_count}
        metadata = json.dumps({**own, **base, "defaultParamMap": plain, **sizes})
        single = lambda t: json.dumps({"class": f"{ml}.DecisionTreeClassificationModel", "uid": f"tree_{t}", "paramMap": {"maxDepth": self.depth}, "defaultParamMap": plain, **base})
        spark.createDataFrame([(metadata,)], "value string").coalesce(1).write.text(f"{path}/metadata")
        spark.createDataFrame([(t, single(t), 1.0) for t in range(self.trees_count)], "_1 int, _2 string, _3 double").write.parquet(f"{path}/treesMetadata")
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/data")
        return RandomForestClassificationModel.load(path)


def _nodes(column, classes: int) -> Nodes:
    """Nodes of one subtree; `column` gives its values by name."""
    whole = [np.array(column(c), np.int64) for c in ("feature", "cut", "left", "count")]
    return Nodes(*whole, np.array(column("gain"), float), np.array(column("stats"), float).reshape(-1, classes))


def _subtrees(found: Sequence[tuple[Nodes, int, int, int]], width: int) -> pa.Table:
    """Rows of `SUBTREE` from (nodes, number, tree, class of its leaves or -1)."""
    nodes, number, tree, top = zip(*found)
    columns = {c: [getattr(n, c).ravel() for n in nodes] for c in COLUMNS}
    columns |= {"weight": [n.importance(width) for n in nodes], "node": number, "tree": tree, "top": top}
    return pa.table({c: pa.array(columns[c], t) for c, t in ARROW.items()})


def _by_node(at: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Different nodes and the rows of each."""
    order = at.argsort(kind="stable")
    nodes, first = np.unique(at[order], return_index=True)
    return nodes, np.split(order, first[1:]) if len(order) else []


def _bins(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, width)


def _binned(rows: DataFrame, cuts: Sequence[np.ndarray], keep: Sequence[str]) -> DataFrame:
    """`rows` (features, kept columns) written with a row number `id` and a byte per feature; kept columns as k0, k1, .."""
    names = [f"k{i}" for i in range(len(keep))]
    x = rows.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], vector_to_array("features").alias("x"), F.monotonically_increasing_id().alias("id"))

    def scan(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _matrix(batch.column("x"), batch.num_rows)
            bins = np.column_stack([np.searchsorted(c, values[:, i], side="left") for i, c in enumerate(cuts)]).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], batch.column("id"), _packed(bins)], names=[*names, "id", "bins"])

    schema = x.select(*names).schema.add("id", "long").add("bins", "binary")
    return cut_lineage(x.mapInArrow(scan, schema))


def split_points(rows: DataFrame, width: int, bins: int = BINS) -> list[np.ndarray]:
    """At most bins - 1 cuts per feature of assembled rows, each halfway between two neighbouring values of the table."""
    x = rows.select(vector_to_array("features").alias("x"))

    def few(batches) -> Iterator[pa.RecordBatch]:
        seen = [np.zeros(0)] * width
        for batch in batches:
            values = _matrix(batch.column("x"), batch.num_rows)
            seen = [np.union1d(s, values[:, i])[: bins + 1] if len(s) <= bins else s for i, s in enumerate(seen)] if batch.num_rows else seen
        places = np.repeat(np.arange(width), [len(s) for s in seen])
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array(np.concatenate(seen))], names=["f", "v"])

    kinds = x.mapInArrow(few, "f int, v double").distinct().groupBy("f").agg(F.count("*").alias("n"), F.collect_list("v").alias("v"))
    exact = {r["f"]: np.sort(r["v"]) for r in kinds.filter(F.col("n") <= bins).collect()}
    ends = [(v[1:] + v[:-1]) / 2 if (v := exact.get(i)) is not None else None for i in range(width)]
    many = [i for i in range(width) if ends[i] is None]
    if not many:
        return ends
    near = quantile_cuts(x.select(*[F.col("x")[i].alias(f"f{i}") for i in many]), [f"f{i}" for i in many], bins)

    def above(batches) -> Iterator[pa.RecordBatch]:
        least = np.full((len(many), bins + 1), np.inf)
        for batch in batches:
            values = _matrix(batch.column("x"), batch.num_rows)
            for j, i in enumerate(many if batch.num_rows else []):
                np.minimum.at(least[j], np.searchsorted(near[j], values[:, i], side="left"), values[:, i])
        hit = np.argwhere(np.isfinite(least))
        yield pa.RecordBatch.from_arrays([pa.array(hit[:, 0], pa.int32()), pa.array(hit[:, 1], pa.int32()), pa.array(least[tuple(hit.T)])], names=["f", "b", "v"])

    least = np.full((len(many), bins + 1), np.inf)
    for f, b, v in x.mapInArrow(above, "f int, b int, v double").groupBy("f", "b").agg(F.min("v")).collect():  # bins per feature
        least[f, b] = v
    for j, i in enumerate(many):
        following = np.minimum.accumulate(least[j, ::-1])[::-1][1 : len(near[j]) + 1]
        kept = np.isfinite(following)
        ends[i] = np.unique((near[j][kept] + following[kept]) / 2)
    return ends


def _upper_splits(
    written: DataFrame, upper: Nodes, tree: np.ndarray, active: Sequence[int], width: int, tried: int, weights: np.ndarray, seed: int
) -> dict[int, tuple]:
    """Node -> (feature or -1, cut, gain, rows per class, rows per class on the left) of the active nodes, in one pass."""
    classes = len(weights)
    place = np.full(len(tree), -1)
    place[active] = np.arange(len(active))
    used = np.unique(tree[active])
    subset = np.concatenate([_subsets(np.random.default_rng([seed, n]), 1, width, tried) for n in active])

    def scan(batches) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(active), tried * BINS * classes))
        for batch in batches:
            bins, ids, y = _bins(batch, width), batch.column("id").to_numpy(), _classes(batch)
            for t in used:
                drawn = _drawn(ids, t, seed)
                rows = np.flatnonzero(drawn)
                at = place[upper.leaves(bins[rows], np.full(len(rows), t))]
                rows, at = rows[at >= 0], at[at >= 0]
                for j in range(tried):
                    cell = ((at * tried + j) * BINS + bins[rows, subset[at, j]]) * classes + y[rows]
                    np.add.at(total.ravel(), cell, drawn[rows].astype(float))
        hit = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), _packed(total[hit])], names=["place", "counts"])

    def choose(key, table):
        at = int(key[0].as_py())
        found = _unpacked(table.column("counts"), float, tried * BINS * classes).sum(axis=0).reshape(tried, BINS, classes)
        gain, cut = best_cut(found, weights)
        j = int(gain.argmax())
        row = (at, int(subset[at, j]) if gain[j] > 0 else -1, int(cut[j]), float(gain[j]), found[0].sum(axis=0), found[j, : cut[j] + 1].sum(axis=0))
        return pa.table([pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.int32(), pa.float64(), REALS, REALS))], names=names)

    names = ["place", "feature", "cut", "gain", "counts", "lefts"]
    sums = written.mapInArrow(scan, "place int, counts binary").repartition(min(PARTS, len(active)), "place")
    best = sums.groupBy("place").applyInArrow(choose, "place int, feature int, cut int, gain double, counts array<double>, lefts array<double>")
    return {active[r[0]]: (r[1], r[2], r[3], np.array(r[4]), np.array(r[5])) for r in best.collect()}  # a row per node


def _classes(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("k0").to_numpy(zero_copy_only=False).astype(np.int64)


def _blank(n: int, classes: int) -> Nodes:
    return Nodes(np.full(n, -1), np.zeros(n, np.int64), np.full(n, -1), np.zeros(n, np.int64), np.zeros(n), np.zeros((n, classes)))


def fit(
    rows: DataFrame, features: Sequence[str], label: str, balanced: bool, trees: int, depth: int, seed: int, group: int = GROUP
) -> Forest:
    """Forest of assembled rows (features, label); classes weigh n / (classes x class size) if `balanced`, else 1."""
    width = len(features)
    tried = int(np.ceil(np.sqrt(width))) if trees > 1 else width
    cuts = split_points(rows, width)
    written = _binned(rows, cuts, [label])
    sizes = {r[0]: r[1] for r in written.groupBy("k0").count().collect()}  # a row per class
    if not sizes:
        raise ValueError("no rows to fit")
    if any(k is None or k != k or k != int(k) or not 0 <= k < CLASSES for k in sizes):
        raise ValueError(f"labels 0, 1, .. {CLASSES - 1} expected")
    counts = np.zeros(max(2, int(max(sizes)) + 1))
    for k, n in sizes.items():
        counts[int(k)] = n
    classes, total = len(counts), int(counts.sum())
    weights = total / (len(sizes) * np.maximum(counts, 1)) if balanced else np.ones(classes)

    # upper nodes: a leaf is closed when it needs no group
    upper, tree, level, closed = _blank(trees, classes), np.arange(trees), np.zeros(trees, np.int64), np.zeros(trees, bool)
    active = list(range(trees)) if total > group and depth > 0 else []
    while active:
        found = {}
        for first in range(0, len(active), NODES):
            found.update(_upper_splits(written, upper, tree, active[first : first + NODES], width, tried, weights, seed))
        new = []
        split = [n for n in active if found[n][0] >= 0]
        fresh, start = _blank(2 * len(split), classes), len(tree)
        upper = Nodes(*[np.concatenate([getattr(upper, c), getattr(fresh, c)]) for c in COLUMNS])
        tree, level = np.append(tree, np.repeat(tree[split], 2)), np.append(level, np.repeat(level[split], 2) + 1)
        closed = np.append(closed, np.zeros(2 * len(split), bool))
        for node in active:
            feature, cut, gain, inside, left = found[node]
            upper.stats[node], upper.count[node], closed[node] = inside * weights, inside.sum(), feature < 0
            if feature < 0:
                continue
            upper.feature[node], upper.cut[node], upper.left[node], upper.gain[node] = feature, cut, start, gain
            for kid, side in ((start, left), (start + 1, inside - left)):
                upper.stats[kid], upper.count[kid] = side * weights, side.sum()
                closed[kid] = level[kid] >= depth or (side > 0).sum() < 2
                if not closed[kid] and side.sum() > group:
                    new.append(kid)
            start += 2
        active = new

    def deal(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, ids, y = _bins(batch, width), batch.column("id").to_numpy(), _classes(batch).astype(np.uint8)
            for t in range(trees):
                drawn = _drawn(ids, t, seed)
                use = np.flatnonzero(drawn)
                at = upper.leaves(bins[use], np.full(len(use), t))
                use, at = use[~closed[at]], at[~closed[at]]
                nodes, parts = _by_node(at)
                packed = np.column_stack([drawn, y, bins])[use]
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int32()), _packed([packed[p] for p in parts])], names=["node", "data"])

    def finish(key, table):
        node = int(key[0].as_py())
        data = _unpacked(table.column("data"), np.uint8, width + 2)
        below = grow(
            data[:, 2:], data[:, 1].astype(np.int64), data[:, 0].astype(float), int(depth - level[node]), tried, weights, np.random.default_rng([seed, node])
        )
        top = below.join()[0]
        return _subtrees([(below.reached(), node, tree[node], top)], width)

    leaves = np.flatnonzero((upper.feature < 0) & ~closed)
    dealt = written.mapInArrow(deal, "node int, data binary").repartition(min(PARTS, max(1, len(leaves))), "node")
    subtrees = cut_lineage(dealt.groupBy("node").applyInArrow(finish, SUBTREE))

    # joins that reach above the groups; upper leaves without a group get a subtree of one node
    given = upper.stats.argmax(axis=1)
    tops = {r[0]: r[1] for r in subtrees.select("node", "top").collect()}  # a row per group
    for node in leaves:
        if node in tops:
            given[node] = tops[node]
        else:  # a tree that drew no row votes as the table is
            upper.stats[node], closed[node] = counts * weights, True
            given[node] = upper.stats[node].argmax()
    inner = upper.feature >= 0
    upper.join(given)
    alone = np.flatnonzero((upper.feature < 0) & (closed | inner))
    if len(alone):
        single = [(Nodes(*[getattr(upper, c)[[n]] for c in COLUMNS]), n, tree[n], -1) for n in alone]
        subtrees = subtrees.unionByName(rows.sparkSession.createDataFrame(_subtrees(single, width)))
    return Forest(list(features), cuts, weights, upper, tree, trees, subtrees, depth, seed)
