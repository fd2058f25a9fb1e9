"""Operators on literal and skewed frames, against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import classify as cl
from ledgerloom.operators import cluster as km
from ledgerloom.operators import profile as pf
from ledgerloom.operators import regression as reg
from ledgerloom.operators import relational as rel
from ledgerloom.operators import series as ser
from ledgerloom.operators.ranks import hash_rank, level_quantiles, quantiles, range_order, ranged
from tests.conftest import values


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most of the rows, one value of it a third of them; heavy tail, ties, NULLs, a single row."""
    random.seed(3)
    data = [("hot", random.choice([7.0, random.lognormvariate(3, 2), None])) for _ in range(4000)]
    data += [("cold", float(i % 11)) for i in range(200)] + [("lone", 1.5), ("same", 2.0), ("same", 2.0), ("none", None)]
    return spark.createDataFrame(data, "g string, v double"), data


def test_quantiles_are_exact(skewed):
    df, data = skewed
    probs = {"q1": 0.25, "med": 0.5, "p99": 0.99, "low": 0.0, "high": 1.0}
    got = {r["g"]: r for r in quantiles(df, ["g"], "v", probs).collect()}
    for g in ("hot", "cold", "lone", "same"):
        vals = [v for k, v in data if k == g and v is not None]
        for name, p in probs.items():
            assert got[g][name] == pytest.approx(np.quantile(vals, p), rel=1e-12), (g, name)
    assert "none" not in got
    whole = quantiles(df, [], "v", {"med": 0.5}).first()["med"]
    assert whole == pytest.approx(np.median([v for _, v in data if v is not None]), rel=1e-12)


@pytest.fixture
def many_ranges(spark):
    """Shuffles keep all their partitions, so a small table has many ranges."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 23)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_quantiles_over_many_ranges(spark, skewed, many_ranges):
    """A hot value, outliers and a group that covers most ranges; the ranges of the distinct values are even."""
    test_quantiles_are_exact(skewed)
    df = spark.range(40_000).select((F.col("id") % 39_989 / 7.0).alias("v")).union(spark.createDataFrame([(1e15,), (1e10,)], "v double"))
    df = df.union(spark.range(20_000).select(F.lit(-3.0)))
    got = quantiles(df, [], "v", {"med": 0.5, "p90": 0.9, "p10": 0.1}).first()
    values_ = [i % 39_989 / 7.0 for i in range(40_000)] + [1e15, 1e10] + [-3.0] * 20_000
    assert tuple(got) == tuple(pytest.approx(np.quantile(values_, p)) for p in (0.5, 0.9, 0.1))
    sizes = [r["n"] for r in ranged(df.distinct(), ["v"]).groupBy("_range").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 69 and max(sizes) < 3 * 39_992 / 69


def test_ranges_ascend(spark, many_ranges):
    found = ranged(spark.range(5000).select((F.col("id") * 7919 % 5003).alias("v")), ["v"])
    bounds = sorted((r[0], r[1], r[2]) for r in found.groupBy(range_order()).agg(F.min("v"), F.max("v")).collect())
    assert len(bounds) == 69 and all(a[2] < b[1] for a, b in zip(bounds, bounds[1:]))


def test_levels_share_one_pass(rows):
    df = rows("a string, b int, v double", ("x", 1, 1.0), ("x", 2, 2.0), ("y", 1, 6.0), (None, 1, 10.0), ("y", None, 8.0), ("x", 1, None))
    found = level_quantiles(df, {"all": [], "a": ["a"], "ab": ["a", "b"]}, "v", {"med": 0.5})
    assert values(found) == values(rows(
        "level string, a string, b int, med double",
        ("all", None, None, 6.0), ("a", "x", None, 1.5), ("a", "y", None, 7.0), ("ab", "x", 1, 1.0), ("ab", "x", 2, 2.0), ("ab", "y", 1, 6.0),
    ))
    assert quantiles(df.filter("false"), ["a"], "v", {"med": 0.5}).collect() == []


def test_hash_rank_is_a_permutation_per_stratum(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 10 == 0, "rare").when(F.col("id") % 7 == 0, None).otherwise("hot").alias("y"))
    got = hash_rank(df, ["y"], "id").collect()
    by = {}
    for r in got:
        by.setdefault(r["y"], []).append((r["_rank"], r["_size"]))
    assert len(got) == 3000 and set(by) == {"rare", "hot", None}
    for ranks in by.values():
        assert sorted(x for x, _ in ranks) == list(range(1, len(ranks) + 1)) and {n for _, n in ranks} == {len(ranks)}


def test_split_folds_and_upsampling_are_exact(spark):
    df = spark.range(1003).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    split = cl.stratified_split(df, "y", "id")
    counts = {(r["y"], r["is_test"]): r["count"] for r in split.groupBy("y", "is_test").count().collect()}
    assert counts == {(1, True): 20, (1, False): 81, (0, True): 180, (0, False): 722}
    again = values(cl.stratified_split(df.repartition(5), "y", "id"))
    assert again == values(split)
    folds = {(r["y"], r["fold"]): r["count"] for r in cl.stratified_folds(df, "y", "id").groupBy("y", "fold").count().collect()}
    for y in (0, 1):
        sizes = [folds[(y, i)] for i in range(5)]
        assert max(sizes) - min(sizes) <= 1
    up = cl.upsample_minority(df, "y", "id")
    sizes = {r["y"]: r["count"] for r in up.groupBy("y").count().collect()}
    assert sizes == {0: 902, 1: 902} and up.filter("copy = 1").count() == 1003


def test_latest_per_key_breaks_ties_by_the_later_columns(rows):
    df = rows("k int, t int, e int, v string", (1, 5, 1, "a"), (1, 5, 2, "b"), (1, 4, 9, "c"), (2, 1, 1, None))
    assert values(rel.latest_per_key(df, ["k"], ["t", "e"], ["v"])) == [(1, "b"), (2, None)]


def test_first_value_skips_nulls(rows):
    df = rows("k int, o int, v string", (1, 1, None), (1, 2, "b"), (1, 3, "a"), (2, 1, None))
    assert values(df.groupBy("k").agg(rel.first_value_per_key("v", "o").alias("v"))) == [(1, "b"), (2, None)]


def test_previous_period_does_not_skip_gaps(rows):
    df = rows("k int, m string, v int", (1, "2021-12", 1), (1, "2022-01", 2), (1, "2022-03", 3), (2, "2022-01", None), (2, "2022-02", 5))
    out = values(rel.with_previous_period(df, ["k"], "m", {"v": "p"}), "k", "m", "p")
    assert out == [(1, "2021-12", None), (1, "2022-01", 1), (1, "2022-03", None), (2, "2022-01", None), (2, "2022-02", None)]
    assert len(values(rel.with_previous_period(df, ["k"], "m", {"v": "p"}, how="inner"))) == 2
    year = rows("k int, m string, v int", (1, "2021-05", 1), (1, "2022-05", 4), (1, "2022-06", 9))
    assert values(rel.with_previous_period(year, ["k"], "m", {"v": "p"}, lag=12), "m", "p")[1] == ("2022-05", 1)


def test_unpivot_drops_nulls_and_pivot_keeps_totals(rows):
    df = rows("p string, m string, a int, b int", ("x", "1", 1, None), ("x", "2", 3, 4), ("y", "3", 5, None))
    long = rel.wide_to_long(df, ["p", "m"], ["a", "b"], "measure", "v")
    assert long.count() == 4
    wide = rel.long_to_wide(long, ["p", "measure"], "m", {"1": "m1", "2": "m2"}, "v")
    assert values(wide) == [("x", "a", 1, 3), ("x", "b", 0, 4), ("y", "a", 0, 0)]


def test_top_and_bottom_ties(rows):
    df = rows("g string, s double, k string", ("a", 1.0, "p"), ("a", 1.0, "q"), ("a", 2.0, "r"), ("a", None, "z"), ("b", 5.0, "x"))
    out = values(rel.top_and_bottom(df, "g", "s", "k", 1), "g", "side", "k")
    assert out == [("a", "best", "p"), ("a", "worst", "r"), ("b", "best", "x"), ("b", "worst", "x")]


def test_lookup_and_set_difference(rows):
    df = rows("k string, v int", ("a", 1), ("b", 2), (None, 3))
    table = rows("code string, name string", ("a", "A"))
    assert values(rel.lookup(df, "k", table, "code", ["name"]), "k", "name") == [(None, None), ("a", "A"), ("b", None)]
    assert values(rel.rows_sharing_no_key(df, "k", rows("k string", ("a",))), "k") == [(None,), ("b",)]


def test_series_windows(rows):
    df = rows("year_month string, v double", *[(f"2020-{m:02d}", float(m)) for m in range(1, 7)])
    out = df.select("year_month", ser.rolling3("v", True).alias("c"), ser.rolling3("v").alias("p"), ser.trailing12("v").alias("n")).orderBy("year_month").collect()
    assert [r["c"] for r in out] == [None, None, 2.0, 3.0, 4.0, 5.0]
    assert [r["p"] for r in out] == [None, None, None, 2.0, 3.0, 4.0]
    assert [r["n"] for r in out] == [None, 1.0, 1.5, 2.0, 2.5, 3.0]


def test_standardise_constant_column(rows):
    out = ser.standardise(rows("a double, b double", (1.0, 2.0), (3.0, 2.0)), ["a", "b"])
    assert values(out, "a_z", "b_z") == [(-1.0, None), (1.0, None)]


def lstsq(x, y):
    design = np.column_stack([np.ones(len(y)), x])
    beta, *_ = np.linalg.lstsq(design, y, rcond=None)
    return beta, design @ beta


def test_ols_matches_least_squares(spark):
    rng = np.random.default_rng(5)
    data = []
    for g, n in (("a", 400), ("b", 40)):
        x = rng.normal(size=(n, 3)) * [1.0, 1e4, 1e-3] + [5.0, 1e6, 0.0]
        y = 3 + x @ np.array([2.0, -1e-3, 50.0]) + rng.normal(size=n)
        data += [(g, *map(float, r), float(t), 1.0) for r, t in zip(x, y)]
    df = spark.createDataFrame(data + [("a", None, 1.0, 1.0, 1.0, 1.0)], "g string, x1 double, x2 double, x3 double, y double, const double")
    specs = {"all": ["x1", "x2", "x3"], "two": ["x1", "x2"], "const": ["x1", "const"]}
    fit = reg.fit_ols(df, "y", specs, ["g"])
    got = {(r["g"], r["spec"]): r for r in fit.collect()}
    for g in ("a", "b"):
        part = np.array([r[1:6] for r in data if r[0] == g], float)
        for spec, names in specs.items():
            cols = [{"x1": 0, "x2": 1, "x3": 2}[n] for n in names if n != "const"]
            beta, pred = lstsq(part[:, cols], part[:, 3])
            row = got[(g, spec)]
            sse, sst = ((part[:, 3] - pred) ** 2).sum(), ((part[:, 3] - part[:, 3].mean()) ** 2).sum()
            assert row["r2"] == pytest.approx(1 - sse / sst, rel=1e-9)
            assert row["intercept"] == pytest.approx(beta[0], rel=1e-6)
            assert [c["coef"] for c in row["coefs"] if c["feature"] != "const"] == pytest.approx(list(beta[1:]), rel=1e-7)
    flat = {c["feature"]: c["coef"] for c in got[("a", "const")]["coefs"]}
    assert flat["const"] == 0.0
    scored = reg.score_ols(df.dropna(), fit, ["x1", "x2", "x3", "const"], ["g"])
    quality = {(r["g"], r["spec"]): r["r2"] for r in reg.accuracy(scored, F.col("y"), F.col("predicted"), ["g", "spec"]).collect()}
    for key, row in got.items():
        assert quality[key] == pytest.approx(row["r2"], rel=1e-7)


def test_simple_and_multiple_fit_agree(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=60)
    df = spark.createDataFrame([(float(a), float(2 * a + b)) for a, b in zip(x, rng.normal(size=60))], "x double, y double")
    s = reg.simple_ols(df, [("x", "y")]).first()
    m = reg.fit_ols(df, "y", {"s": ["x"]}).first()
    assert s["slope"] == pytest.approx(m["coefs"][0]["coef"]) and s["p"] == pytest.approx(m["coefs"][0]["p"], rel=1e-6)
    assert s["f_stat"] == pytest.approx(m["f_stat"]) and m["p_f"] == pytest.approx(s["p"], rel=1e-6)
    assert s["ci_lo"] < s["slope"] < s["ci_hi"]


def test_dominant_driver_passes_over_constants(rows):
    df = rows("y double, a double, b double, c double", (1.0, 1.0, 9.0, 5.0), (2.0, 3.0, 7.5, 5.0), (3.0, 2.0, 6.0, 5.0))
    got = reg.dominant_driver(df, "y", ["c", "a", "b"]).first()
    assert got["driver"] == "b" and got["beta"] == pytest.approx(-1.0)


def test_report_and_auc_by_brute_force(spark):
    random.seed(9)
    data = [(i, int(random.random() < 0.3), random.choice([0.1, 0.4, 0.4, 0.7, random.random()])) for i in range(400)]
    df = spark.createDataFrame(data, "id int, y int, score double").withColumn("prediction", (F.col("score") > 0.5).cast("int"))
    pairs = [(p, n) for _, y, p in data if y for _, z, n in data if not z]
    auc = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in pairs) / len(pairs)
    row = cl.binary_report(df, "y", score="score").first()
    assert row["auc"] == pytest.approx(auc, abs=1e-9)
    tp = sum(1 for _, y, s in data if y and s > 0.5)
    assert row["tp"] == tp and row["support_1"] + row["support_0"] == 400
    empty = cl.binary_report(df.withColumn("prediction", F.lit(0)), "y").first()
    assert empty["precision_1"] == 0.0 and empty["f1_1"] == 0.0


def test_logistic_satisfies_its_optimality_condition(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 2)) * [1.0, 10.0]
    y = (rng.random(300) < 1 / (1 + np.exp(-(x[:, 0] - 0.1 * x[:, 1])))).astype(int)
    df = spark.createDataFrame([(float(a), float(b), int(t)) for (a, b), t in zip(x, y)], "a double, b double, y int")
    model, scaler = cl.logistic(df, ["a", "b"], "y", strength=0.5)
    z = (x - x.mean(0)) / x.std(0)
    w = model.coefficients.toArray()
    p = 1 / (1 + np.exp(-(z @ w + model.intercept)))
    # C * sum of log losses + |w|^2 / 2 has gradient zero
    assert np.abs(0.5 * z.T @ (p - y) + w).max() < 1e-2 and abs((p - y).sum()) < 1e-2
    table = [r["feature"] for r in cl.coefficient_table(df, model, ["a", "b"]).collect()]
    assert table[0] == ["a", "b"][int(np.argmax(np.abs(w)))]
    scored = cl.predict(model, df, ["a", "b"], ["y"], scaler).collect()
    assert [r["score"] for r in scored] == pytest.approx(list(p), abs=1e-6)


def test_balanced_weights(rows):
    out = cl.balanced_weight(rows("y int", (0,), (0,), (0,), (1,)), "y")
    assert values(out) == [(0, pytest.approx(4 / 6)), (0, pytest.approx(4 / 6)), (0, pytest.approx(4 / 6)), (1, 2.0)]


def test_modes_frequencies_and_bins(rows):
    df = rows("g string, v string, x double", ("a", "p", 1.0), ("a", "p", 16.0), ("a", "q", 14.9), ("b", "q", 0.0), ("b", "p", None), ("b", None, 31.0))
    assert values(pf.modes(df, ["g"], "v", "m")) == [("a", "p"), ("b", "p")]
    assert (None, 1) in values(pf.frequencies(df, "v"))
    assert values(pf.binned_shares(df, "g", "x", 15), "g", "bin_start", "share_pct") == [("a", 0, pytest.approx(200 / 3)), ("a", 15, pytest.approx(100 / 3)), ("b", 0, 50.0), ("b", 30, 50.0)]


def test_missing_profile_and_fences(rows):
    df = rows("a double", *[(float(i),) for i in range(1, 10)], (100.0,), (None,))
    r = pf.missing_profile(df, ["a"]).first()
    vals = [*range(1, 10), 100]
    q1, q3 = np.quantile(vals, [0.25, 0.75])
    assert (r["n"], r["missing"], r["outliers"]) == (11, 1, 1)
    assert (r["low"], r["high"]) == (pytest.approx(q1 - 1.5 * (q3 - q1)), pytest.approx(q3 + 1.5 * (q3 - q1)))


def test_medians_are_filled_from_the_training_rows(rows):
    train = rows("a double, b double", (1.0, 10.0), (3.0, None), (8.0, 30.0))
    test = rows("a double, b double", (None, None), (5.0, 1.0))
    assert values(pf.fill_medians(test, ["a", "b"], train)) == [(3.0, 20.0), (5.0, 1.0)]


def test_collinear_columns_are_dropped_in_order(spark):
    rng = np.random.default_rng(0)
    a = rng.normal(size=200)
    df = spark.createDataFrame([(float(x), float(x * 2 + 1e-3 * e), float(z)) for x, e, z in zip(a, rng.normal(size=200), rng.normal(size=200))], "a double, b double, c double")
    assert pf.without_collinear(df, ["a", "b", "c"]) == ["a", "c"]


def test_t_test(rows):
    df = rows("g string, v double", *[("a", v) for v in (1.0, 2.0, 3.0, 4.0)], *[("b", v) for v in (2.0, 4.0, 6.0, 8.0)], ("c", 99.0))
    r = pf.t_test(df, "g", "a", "b", "v").first()
    assert r["t_pooled"] == pytest.approx(-1.7320508, abs=1e-6) and r["dof_pooled"] == 6
    assert r["dof_welch"] == pytest.approx(4.4117647, abs=1e-6) and not r["significant"]


def test_tenure_and_workload(rows):
    df = rows("h int, y int", (175, 1), (176, 2), (None, 6), (0, None))
    assert [tuple(r) for r in df.select(pf.workload_flag(F.col("h")), pf.tenure_bucket(F.col("y"))).collect()] == [(0, "<2"), (1, "2-3"), (None, "6+"), (0, None)]


def test_kmeans_finds_separated_groups(spark):
    df = spark.createDataFrame([(i, float(i % 3) * 50 + (i // 3) * 0.1, float(i % 3) * 20) for i in range(60)], "id int, a double, b double")
    table, labelled = km.sweep(df, ["a", "b"], ["id"], ks=(2, 3), starts=2)
    best = [r for r in table.collect() if r["is_best"]]
    assert len(best) == 1 and best[0]["k"] == 3 and best[0]["silhouette"] > 0.95
    got = {}
    for r in labelled.collect():
        got.setdefault(r["id"] % 3, set()).add(r["cluster_k3"])
    assert all(len(v) == 1 for v in got.values()) and len(set.union(*got.values())) == 3


def test_cross_validation_and_grid(spark):
    df = spark.range(200).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 7 > 3).cast("int").alias("y"))
    out = cl.cross_validate(df, ["a"], "y", "id", k=2)
    assert out.filter("fold = 'mean'").first()["auc"] == pytest.approx(1.0)
    grid = cl.grid_search(df, ["a"], "y", "id", depths=(2,), trees=(3, 5), k=2)
    assert grid.count() == 2 and grid.first()["mean_auc"] > 0.9


def test_a_specification_keeps_rows_that_only_others_lack(spark):
    """A model without spend is fitted on months without spend, too."""
    data = [(float(i), float(i % 7), None if i % 2 else float(i % 5), 2.0 * i - (i % 7) + 0.1 * (i % 3)) for i in range(40)]
    df = spark.createDataFrame(data, "a double, b double, spend double, y double")
    fit = {r["spec"]: r for r in reg.fit_ols(df, "y", {"plain": ["a", "b"], "spend": ["a", "b", "spend"]}).collect()}
    assert (fit["plain"]["n"], fit["spend"]["n"]) == (40, 20)
    for spec, names in (("plain", (0, 1)), ("spend", (0, 1, 2))):
        rows = [r for r in data if all(r[i] is not None for i in names)]
        x = np.column_stack([np.ones(len(rows)), *[[r[i] for r in rows] for i in names]])
        beta = np.linalg.lstsq(x, np.array([r[3] for r in rows]), rcond=None)[0]
        assert fit[spec]["intercept"] == pytest.approx(beta[0]) and [c["coef"] for c in fit[spec]["coefs"]] == pytest.approx(list(beta[1:]))
    scored = reg.score_ols(df, reg.fit_ols(df, "y", {"plain": ["a", "b"], "spend": ["a", "b", "spend"]}), ["a", "b", "spend"])
    assert {r["spec"]: r["n"] for r in scored.dropna(subset=["predicted"]).groupBy("spec").agg(F.count("*").alias("n")).collect()} == {"plain": 40, "spend": 20}


def test_forest_grows_deeper_than_five(spark):
    bits = [f"x{i}" for i in range(9)]
    rows = spark.range(512).selectExpr(*[f"cast(shiftright(id, {i}) & 1 AS double) AS x{i}" for i in range(9)], "cast(pmod(xxhash64(id), 2) AS int) AS y")
    rows = rows.selectExpr("*", "explode(sequence(1, 8)) AS copy").drop("copy")
    deep, shallow = (cl.forest(rows, bits, "y", trees=8, balanced=False, **k) for k in ({}, {"depth": 5}))
    assert max(t.depth for t in deep.trees) > 5 and max(t.depth for t in shallow.trees) == 5
    right = lambda m: cl.predict(m, rows, bits, ["y"]).filter("y = prediction").count()
    assert right(deep) > right(shallow)
