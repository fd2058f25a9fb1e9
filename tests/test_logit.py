import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import classify as cl
from ledgerloom.operators import logit as lg


def data(n=600, d=4, seed=1, noise=1.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * [1, 10, 0.1, 5][:d] + [0, 100, 3, -2][:d]
    z = (x - x.mean(0)) / x.std(0)
    y = (z @ [1.5, -1.0, 0.3, 0.0][:d] + noise * rng.logistic(size=n) > 0.4).astype(int)
    return x, y


def frame(spark, x, y, fold=None):
    fold = np.zeros(len(x), int) if fold is None else fold
    rows = [(i, int(b), int(f), *map(float, a)) for i, (a, b, f) in enumerate(zip(x, y, fold))]
    return spark.createDataFrame(rows, "id long, y int, fold int, " + ", ".join(f"f{i} double" for i in range(x.shape[1])))


def gradient(model, x, y, strength=1.0):
    """Gradient of the penalised loss at a model, worked out from the rows."""
    z = (x - model.means) / model.deviations
    p = 1 / (1 + np.exp(-(z @ model.weights + model.intercept)))
    return np.r_[(p - y).sum(), z.T @ (p - y) + model.weights / strength]


def test_every_fold_is_at_its_optimum(spark):
    """Gradient zero on the rows of the other folds, with their own means and deviations, folds of uneven size."""
    x, y = data()
    fold = np.arange(600) % 7 % 4
    names = [f"f{i}" for i in range(4)]
    models = lg.fit_parts(frame(spark, x, y, fold).repartition(5), names, "y", "fold", 0.7)
    assert sorted(models) == [0, 1, 2, 3]
    for k, m in models.items():
        own = fold != k
        assert m.rows == own.sum() and np.allclose(m.means, x[own].mean(0)) and np.allclose(m.deviations, x[own].std(0))
        assert np.abs(gradient(m, x[own], y[own], 0.7)).max() < 1e-6 and 2 < m.steps < 15
    whole = lg.fit_parts(frame(spark, x, y), names, "y")[None]
    assert np.abs(gradient(whole, x, y)).max() < 1e-6
    scored = lg.held_out_scores(frame(spark, x, y, fold), models, "fold").collect()
    assert all(r.score == pytest.approx(models[r.fold].score(x[r.id : r.id + 1])[0], rel=1e-12) for r in scored)


def test_same_model_as_the_library(spark):
    x, y = data(300)
    names = [f"f{i}" for i in range(4)]
    df = frame(spark, x, y)
    own = lg.fit_parts(df, names, "y")[None]
    model, _ = cl.logistic(df, names, "y")
    assert np.allclose(own.weights, model.coefficients.toArray(), atol=1e-5) and own.intercept == pytest.approx(model.intercept, abs=1e-5)


def test_constant_column_and_separable_classes(spark):
    x, y = data(200, 2, noise=0.0)
    x = np.column_stack([x, np.full(200, 7.0)])
    m = lg.fit_parts(frame(spark, x, y), ["f0", "f1", "f2"], "y", strength=100.0)[None]
    assert m.weights[2] == 0.0 and np.isfinite(m.weights).all() and np.abs(m.weights).max() > 3
    assert np.abs(gradient(m, x, y, 100.0)).max() < 1e-6
    assert ((m.score(x) > 0.5) == (y == 1)).mean() > 0.98


def test_single_class_missing_values_and_no_rows(spark):
    x, y = data(60, 2)
    fold = np.where(y == 1, 0, 1 + np.arange(60) % 2)  # without fold 0 there is one class
    models = lg.fit_parts(frame(spark, x, y, fold), ["f0", "f1"], "y", "fold")
    assert models[0].score(x[:3]).max() < 1e-10 and models[1].steps > 0
    df = frame(spark, x, y).withColumn("f0", F.when(F.col("id") % 3 > 0, F.col("f0")))
    kept = np.arange(60) % 3 > 0
    m = lg.fit_parts(df, ["f0", "f1"], "y")[None]
    assert m.rows == kept.sum() and np.abs(gradient(m, x[kept], y[kept])).max() < 1e-6
    assert lg.held_out_scores(df, {0: m}, "fold").filter("score is null").count() == 20
    none = lg.fit_parts(df.filter("false"), ["f0", "f1"], "y")[None]
    assert none.score(x[:2]).tolist() == [0.5, 0.5]


def test_auc_per_group(spark):
    rng = np.random.default_rng(5)
    rows = [(g, int(rng.random() < 0.4), float(rng.integers(0, 30))) for g in ["hot"] * 2000 + ["cold"] * 50] + [("one", 1, 3.0), (None, 1, 2.0), (None, 0, 1.0), (None, 0, 2.0)]
    df = spark.createDataFrame(rows, "g string, y int, score double")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 13)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["g"]: r["auc"] for r in cl.grouped_auc(df, ["g"], "y").collect()}
        whole = cl.grouped_auc(df.filter("g is not null"), [], "y").first()["auc"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")

    def brute(use):
        pos, neg = [s for g, y, s in rows if use(g) and y], [s for g, y, s in rows if use(g) and not y]
        return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))

    for g in ("hot", "cold", None):
        assert got[g] == pytest.approx(brute(lambda x: x == g))
    assert got["one"] is None and whole == pytest.approx(brute(lambda x: x is not None))


def test_number_of_jobs_does_not_depend_on_the_folds(spark):
    x, y = data(400)
    names = [f"f{i}" for i in range(4)]
    df = frame(spark, x, y).drop("fold").cache()
    tracker = spark.sparkContext.statusTracker()
    jobs = {}
    for k in (3, 10):
        spark.sparkContext.setJobGroup(f"cv{k}", "")
        found = cl.cross_validate(df, names, "y", "id", k)
        assert found.count() == k + 2
        jobs[k] = len(tracker.getJobIdsForGroup(f"cv{k}"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    df.unpersist()
    assert jobs[10] <= jobs[3] + 6  # a few Newton steps more or less
