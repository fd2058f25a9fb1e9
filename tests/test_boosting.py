import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import boosting as bo
from ledgerloom.operators import classify as cl


def data(n=300, seed=1):
    """Continuous, coarse and constant features, one with a third of its values missing (and that says something)."""
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 5, n), np.full(n, 2.0), rng.lognormal(size=n)]).astype(float)
    lost = rng.random(n) < 0.33
    y = ((x[:, 0] > 0.2) ^ (x[:, 1] > 2) | lost & (rng.random(n) < 0.7)).astype(int)
    x[lost, 3] = np.nan
    return x, y


def frame(spark, x, y):
    rows = [(i, int(b), *[None if np.isnan(v) and i % 2 else float(v) for v in a]) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, y int, " + ", ".join(f"f{i} double" for i in range(x.shape[1])))


NAMES = [f"f{i}" for i in range(4)]


def gain_of(g, h, left, l2, gamma):
    def part(use):
        return g[use].sum() ** 2 / (h[use].sum() + l2)

    return 0.5 * (part(left) + part(~left) - part(np.ones(len(g), bool))) - gamma


def best_gain(x, g, h, cuts, l2, gamma, least):
    """Largest gain of any feature, cut and side of the missing values, row by row."""
    out = -np.inf
    for f in range(x.shape[1]):
        for c in cuts[f]:
            for side in (False, True):
                left = np.where(np.isnan(x[:, f]), side, x[:, f] <= c)
                if left.any() and (~left).any() and h[left].sum() >= least and h[~left].sum() >= least:
                    out = max(out, gain_of(g, h, left, l2, gamma))
    return out


@pytest.mark.parametrize("l2,gamma,least,carry", [(1.0, 0.0, 1.0, 10), (0.3, 0.5, 3.0, 2)])
def test_every_split_is_the_best_one(spark, l2, gamma, least, carry):
    """Each node of each tree against all possible splits of its rows, and all leaf weights and scores."""
    x, y = data()
    rate, rounds, depth = 0.4, 5, 3
    model = bo.boost(frame(spark, x, y).repartition(6), NAMES, "y", rounds, depth, rate, l2, gamma, least, carry=carry)
    assert len(model.trees) == rounds and len(model.cuts[1]) == 5 and len(model.cuts[2]) == 1
    margin = np.zeros(len(x))
    splits = 0
    for tree in model.trees:
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        at, level = {0: np.arange(len(x))}, {0: 0}
        for node in range(len(tree.feature)):
            rows = at[node]
            assert tree.weight[node] == pytest.approx(-rate * g[rows].sum() / (h[rows].sum() + l2), rel=1e-9)
            best = best_gain(x[rows], g[rows], h[rows], model.cuts, l2, gamma, least)
            f = tree.feature[node]
            if f < 0:
                assert level[node] == depth or best < 1e-9
                margin[rows] += tree.weight[node]
                continue
            splits += 1
            cut = model.cuts[f][tree.cut[node]]
            left = np.where(np.isnan(x[rows, f]), tree.missing_left[node], x[rows, f] <= cut)
            assert tree.gain[node] == pytest.approx(gain_of(g[rows], h[rows], left, l2, gamma)) and tree.gain[node] == pytest.approx(best)
            for child, part in ((tree.left[node], left), (tree.left[node] + 1, ~left)):
                at[child], level[child] = rows[part], level[node] + 1
    assert splits > 15
    got = {r.id: r for r in model.predict(frame(spark, x, y), ["id", "y"]).collect()}
    assert all(got[i].score == pytest.approx(1 / (1 + np.exp(-m)), rel=1e-9) and got[i].prediction == int(m > 0) for i, m in enumerate(margin))
    share = model.importance()
    assert sum(share.values()) == pytest.approx(1) and share["f2"] == 0


def test_number_of_passes(spark, monkeypatch):
    passes = []
    plain = bo._histograms
    monkeypatch.setattr(bo, "_histograms", lambda *a: passes.append(1) or plain(*a))
    x, y = data(120)
    bo.boost(frame(spark, x, y), NAMES, "y", rounds=3, depth=2)
    assert len(passes) == 6


def test_learns_and_generalises(spark):
    x, y = data(900, 2)
    model = cl.boosted(frame(spark, x[:600], y[:600]), NAMES, "y", rounds=15, depth=4)
    report = cl.binary_report(cl.predict(model, frame(spark, x[600:], y[600:]), NAMES, ["id", "y"]), "y", score="score").first()
    assert report.accuracy > 0.85 and report.auc > 0.9


def test_one_class_no_rows_and_missing_labels(spark):
    x, y = data(40)
    df = frame(spark, x, y)
    sure = bo.boost(df.withColumn("y", F.lit(1)), NAMES, "y", rounds=3, depth=2, min_curvature=0.0)
    assert all(r.prediction == 1 for r in sure.predict(df, ["id"]).collect())
    none = bo.boost(df.filter("false"), NAMES, "y", rounds=2, depth=2)
    assert {r.score for r in none.predict(df, ["id"]).collect()} == {0.5} and none.importance() == dict.fromkeys(NAMES, 0.0)
    part = bo.boost(df.withColumn("y", F.when(F.col("id") < 30, F.col("y"))), NAMES, "y", rounds=1, depth=1)
    assert part.trees[0].weight[0] == pytest.approx(bo.boost(df.filter("id < 30"), NAMES, "y", rounds=1, depth=1).trees[0].weight[0])
