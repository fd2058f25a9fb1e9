"""Forest in tables: subtrees by brute force, upper nodes split in passes, draws, cuts, joined leaves, odd rows."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import classify as cl
from ledgerloom.operators import forests as fo

NAMES = ["a", "b", "c"]


def data(n=600, seed=2):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 20, n), rng.integers(0, 12, n) * 0.5, rng.random(n)]).astype(float)
    return x, ((x[:, 0] > 11) ^ (x[:, 1] > 3.1) | (rng.random(n) < 0.1)).astype(int)


def frame(spark, x, y):
    rows = [(i, int(b), *map(float, a)) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, y int, a double, b double, c double")


def test_driver_gets_no_subtree(spark, monkeypatch):
    """Spark's own forest is not fitted: its nodes would all be in the driver's heap."""
    x, y = data()
    monkeypatch.setattr(cl, "RandomForestClassifier", None)
    model = cl.forest(frame(spark, x, y), NAMES, "y", trees=4)
    assert len(model.upper.feature) == 4 and model.subtrees.count() == 4
    assert model.subtrees.agg(F.sum(F.size("feature"))).first()[0] > 100


def test_best_cut_weighs_only_bins_with_rows():
    """Nodes of few rows: the work follows the rows, not nodes times bins."""
    rng = np.random.default_rng(5)
    nodes, weights = 4096, np.array([0.8, 1.3])
    counts = np.zeros((nodes, fo.BINS, 2))
    np.add.at(counts, (rng.integers(0, nodes - 1, 9000), rng.integers(0, fo.BINS, 9000), rng.integers(0, 2, 9000)), 1.0)
    tracemalloc.start()
    gain, cut = fo.best_cut(counts, weights)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3 * counts.nbytes
    gini = lambda s: 1 - ((s / s.sum()) ** 2).sum()
    for node in (*range(200), nodes - 1):  # the last one has no rows
        whole, best = counts[node].sum(axis=0) * weights, []
        for b in range(fo.BINS):
            a = counts[node, : b + 1].sum(axis=0) * weights
            best.append(gini(whole) - (a.sum() * gini(a) + (whole - a).sum() * gini(whole - a)) / whole.sum() if 0 < a.sum() and counts[node, b + 1 :].any() else 0.0)
        assert gain[node] == pytest.approx(max(best), abs=1e-12)
        assert cut[node] == (next(b for b in range(fo.BINS) if best[b] > max(best) - 1e-12) if max(best) > 1e-12 else 0)


def test_subtree_takes_the_best_cuts_of_its_rows():
    rng = np.random.default_rng(3)
    bins, y, drawn = rng.integers(0, 32, (300, 4)).astype(np.uint8), rng.integers(0, 3, 300), rng.integers(1, 4, 300).astype(float)
    weights = np.array([1.0, 2.5, 0.5])
    nodes = fo.grow(bins, y, drawn, 30, 4, weights, np.random.default_rng(0))
    sums = lambda use: np.array([drawn[use & (y == k)].sum() for k in range(3)]) * weights
    gini = lambda s: 1 - ((s / s.sum()) ** 2).sum()

    def gain(use, feature, cut):
        left = use & (bins[:, feature] <= cut)
        a, b, whole = sums(left), sums(use & ~left), sums(use)
        return gini(whole) - (a.sum() * gini(a) + b.sum() * gini(b)) / whole.sum() if a.sum() and b.sum() else 0.0

    stack, inner = [(0, np.ones(300, bool))], 0
    while stack:
        node, use = stack.pop()
        assert nodes.stats[node] == pytest.approx(sums(use)) and nodes.count[node] == drawn[use].sum()
        best = max(gain(use, f, c) for f in range(4) for c in range(31))
        if nodes.feature[node] < 0:
            assert len(set(y[use])) == 1 or best < 1e-12
            continue
        inner += 1
        assert nodes.gain[node] == pytest.approx(best) == pytest.approx(gain(use, nodes.feature[node], nodes.cut[node]))
        left = use & (bins[:, nodes.feature[node]] <= nodes.cut[node])
        stack += [(nodes.left[node], left), (nodes.left[node] + 1, use & ~left)]
    assert inner > 50


def test_upper_nodes_split_in_passes_give_the_same_tree(spark):
    """One tree tries all features, so nothing is drawn for its nodes: split by passes or by one group, it is the same."""
    x, y = data()
    rows = cl.assembled(frame(spark, x, y).repartition(3), NAMES, ["y"])
    one, many = (fo.fit(rows, NAMES, "y", True, 1, 30, 42, group) for group in (10**6, 40))
    assert len(one.upper.feature) == 1 and len(many.upper.feature) > 15

    def shape(node):
        if node.getClass().getSimpleName() == "LeafNode":
            return node.prediction(), [round(node.impurityStats().stats()[i], 6) for i in range(2)]
        return node.split().featureIndex(), node.split().threshold(), round(node.gain(), 9), shape(node.leftChild()), shape(node.rightChild())

    assert shape(one.trees[0]._java_obj.rootNode()) == shape(many.trees[0]._java_obj.rootNode())
    assert one.featureImportances.toArray() == pytest.approx(many.featureImportances.toArray())
    df = frame(spark, x, y)
    scores = [{r.id: r.score for r in cl.predict(m, df, NAMES, ["id"]).collect()} for m in (one, many)]
    assert scores[0] == pytest.approx(scores[1]) and len(scores[0]) == len(y)


def test_forest_learns_with_split_upper_nodes(spark):
    x, y = data(1500)
    tx, ty = data(500, 9)
    rows = cl.assembled(frame(spark, x, y), NAMES, ["y"])
    model = fo.fit(rows, NAMES, "y", True, 30, 30, 42, 200)
    assert len(model.upper.feature) > 100
    scored = cl.predict(model, frame(spark, tx, ty), NAMES, ["id", "y"])
    assert scored.count() == 500 and cl.roc_auc(scored, "y") > 0.85
    spark_model = sum(np.array([r.probability[1] for r in t.transform(cl.assembled(frame(spark, tx, ty), NAMES, ["id"])).orderBy("id").collect()]) for t in model.trees)
    got = {r.id: r.score for r in scored.collect()}
    assert [got[i] for i in range(500)] == pytest.approx(list(spark_model / 30))


def test_draws_are_poisson_and_differ_by_tree():
    ids = np.arange(200_000)
    a, b = fo._drawn(ids, 0, 42), fo._drawn(ids, 1, 42)
    assert a.mean() == pytest.approx(1, abs=0.01) and a.var() == pytest.approx(1, abs=0.02) and (a == 0).mean() == pytest.approx(np.exp(-1), abs=0.005)
    assert abs(np.corrcoef(a, b)[0, 1]) < 0.01 and (a == fo._drawn(ids, 0, 42)).all()


def test_cuts_lie_between_all_values_or_near_quantiles(spark):
    x = np.column_stack([np.arange(4000) % 5, np.arange(4000) == 7, np.arange(4000) ** 2, np.ones(4000)])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double, d double").repartition(4)
    cuts = fo.split_points(cl.assembled(df, list("abcd")), 4)
    assert list(cuts[0]) == [0.5, 1.5, 2.5, 3.5] and list(cuts[1]) == [0.5] and len(cuts[3]) == 0
    assert len(cuts[2]) == 31 and not set(cuts[2]) & set(x[:, 2])
    assert np.abs(np.diff(np.searchsorted(x[:, 2], [0, *cuts[2], 2e7])) - 125).max() <= 30


def test_leaves_that_agree_are_joined():
    nodes = fo.Nodes(
        np.array([0, 1, -1, -1, -1]), np.zeros(5, int), np.array([1, 3, -1, -1, -1]), np.ones(5, int), np.array([0.3, 0.1, 0, 0, 0]),
        np.array([[6.0, 4], [5, 1], [1, 3], [3, 0], [2, 1]]),
    )
    assert nodes.join()[0] == -1
    left = nodes.reached()
    assert list(left.feature) == [0, -1, -1] and list(left.left) == [1, -1, -1] and left.stats.tolist() == [[6, 4], [5, 1], [1, 3]]


def test_odd_tables(spark):
    x, y = data(60)
    df = frame(spark, x, y)
    with pytest.raises(ValueError):
        cl.forest(df.filter("id < 0"), NAMES, "y", trees=2)
    with pytest.raises(ValueError):
        cl.forest(df.withColumn("y", F.lit(0.5)), NAMES, "y", trees=2)
    with pytest.raises(Exception, match="null"):
        cl.forest(df.withColumn("a", F.when(F.col("id") > 3, F.col("a"))), NAMES, "y", trees=2)
    alone = cl.forest(df.withColumn("y", F.lit(1)), NAMES, "y", trees=3)
    assert {(r.prediction, r.score) for r in cl.predict(alone, df, NAMES, ["id"]).collect()} == {(1, 1.0)}
    lone = cl.forest(df.limit(1), NAMES, "y", trees=20)  # some trees draw no row
    assert cl.predict(lone, df, NAMES, ["id"]).count() == 60 and lone.subtrees.count() == 20
    assert cl.predict(lone, df.filter("id < 0"), NAMES, ["id"]).count() == 0
