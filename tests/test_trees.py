"""Tree models node by node: splits by brute force, class shares, importances, and reports from the predictions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import classify as cl
from ledgerloom.plans import bakeoff

NAMES = ["a", "b", "c"]


def data(n=280, seed=5):
    """At most 20 values per feature, so that every cut between two values is one that the library tries."""
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 20, n), rng.integers(0, 12, n) * 0.5, rng.integers(0, 3, n)]).astype(float)
    y = ((x[:, 0] > 11) ^ (x[:, 1] > 3.1) | (rng.random(n) < 0.1)).astype(int)
    return x, y


@pytest.fixture(scope="module")
def table(spark):
    x, y = data()
    df = spark.createDataFrame([(i, int(b), *map(float, a)) for i, (a, b) in enumerate(zip(x, y))], "id long, y int, a double, b double, c double")
    return df.persist(), x, y


def gini(y, w):
    p = w[y == 1].sum() / w.sum()
    return 2 * p * (1 - p)


def gain(y, w, left):
    share = w[left].sum() / w.sum()
    return gini(y, w) - share * gini(y[left], w[left]) - (1 - share) * gini(y[~left], w[~left])


def best_gain(x, y, w):
    out = 0.0
    for f in range(x.shape[1]):
        for cut in np.unique(x[:, f])[:-1]:
            out = max(out, gain(y, w, x[:, f] <= cut))
    return out


def walk(node, rows):
    """(node, rows, is leaf) of every node of a fitted tree, rows as dealt by its own splits."""
    if node.getClass().getSimpleName() == "LeafNode":
        yield node, rows, True
        return
    yield node, rows, False
    split = node.split()
    left = rows[0][:, split.featureIndex()] <= split.threshold()
    for child, use in ((node.leftChild(), left), (node.rightChild(), ~left)):
        yield from walk(child, tuple(r[use] for r in rows))


def test_every_split_of_a_tree_is_the_best_one(table):
    df, x, y = table
    model = cl.tree(df, NAMES, "y", depth=5)
    w = np.ones(len(y))
    inner = 0
    scored = {r.id: r for r in cl.predict(model, df, NAMES, ["id", "y"]).collect()}
    ids = np.arange(len(y))
    for node, (xs, ys, ws, at), leaf in walk(model._java_obj.rootNode(), (x, y, w, ids)):
        stats = [node.impurityStats().stats()[i] for i in range(2)]
        assert stats == [float((ys == 0).sum()), float((ys == 1).sum())]
        if leaf:
            for i in at:
                assert scored[i].score == pytest.approx(ys.mean()) and scored[i].prediction == int(ys.mean() > 0.5)
            continue
        inner += 1
        split = node.split()
        assert node.gain() == pytest.approx(gain(ys, ws, xs[:, split.featureIndex()] <= split.threshold()))
        assert node.gain() == pytest.approx(best_gain(xs, ys, ws))
    assert inner >= 5


def test_forest_importances_follow_its_nodes(spark, table):
    """Gain times weight per feature, each tree normalised, then the mean: the table that the report shows."""
    df, x, y = table
    model = cl.forest(df, NAMES, "y", trees=7, depth=30)
    total = np.zeros(3)
    depths = []
    for tree in model.trees:
        own = np.zeros(3)
        stack = [(tree._java_obj.rootNode(), 0)]
        while stack:
            node, depth = stack.pop()
            if node.getClass().getSimpleName() == "LeafNode":
                depths.append(depth)
                continue
            own[node.split().featureIndex()] += node.gain() * node.impurityStats().count()
            stack += [(node.leftChild(), depth + 1), (node.rightChild(), depth + 1)]
        total += own / own.sum()
    want = dict(zip(NAMES, total / total.sum()))
    got = {r.feature: r.importance for r in cl.importance_table(df, model, NAMES).collect()}
    assert got == {f: pytest.approx(v, rel=1e-6) for f, v in want.items()} and max(depths) > 5
    scored = cl.predict(model, df, NAMES, ["id", "y"]).collect()
    votes = np.zeros((len(y), 2))
    for tree in model.trees:
        shares = {r.id: r.probability.toArray() for r in tree.transform(cl.assembled(df, NAMES, ["id"])).collect()}
        votes += np.array([shares[i] for i in range(len(y))])
    assert all(r.score == pytest.approx(votes[r.id, 1] / votes[r.id].sum()) for r in scored)


def test_comparison_report_from_the_predictions(spark, table):
    df, *_ = table
    report = {r.model: r for r in bakeoff.compare_classifiers(df, NAMES, "y", "id", trees=5, rounds=4, depth=6).collect()}
    split = cl.stratified_split(df.select("id", "y", *NAMES), "y", "id")
    train, test = split.filter("NOT is_test"), split.filter("is_test")
    scored = bakeoff.fit_and_score(train, test, NAMES, "y", "id", trees=5, rounds=4, depth=6)
    assert set(report) == set(bakeoff.MODELS) == set(scored)
    for name, rows in scored.items():
        got = [(r.y, r.prediction, r.score) for r in rows.collect()]
        tp, fp = sum(a and b for a, b, _ in got), sum(b and not a for a, b, _ in got)
        fn, tn = sum(a and not b for a, b, _ in got), sum(not a and not b for a, b, _ in got)
        r = report[name]
        assert (r.tp, r.fp, r.fn, r.tn) == (tp, fp, fn, tn) and r.accuracy == pytest.approx((tp + tn) / len(got))
        pos, neg = [s for a, _, s in got if a], [s for a, _, s in got if not a]
        auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
        assert r.auc == pytest.approx(auc)


def test_grid_search_scores_every_pair(table):
    df, *_ = table
    grid = cl.grid_search(df, NAMES, "y", "id", depths=(2, 4), trees=(3,), k=3)
    rows = grid.collect()
    assert {(r.max_depth, r.num_trees) for r in rows} == {(2, 3), (4, 3)} and all(0.5 < r.mean_auc <= 1 for r in rows)
    assert grid.agg(F.max("mean_auc")).first()[0] == rows[0].mean_auc
