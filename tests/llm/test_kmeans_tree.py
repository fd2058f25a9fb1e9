import numpy as np
import pytest

from ledgerloom.llm import kmeans_tree as kt

SCHEMA = "vec_id bigint, embedding array<float>, id int, v string, leaf int"


def brute(rows, every, k):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    out = {}
    for q in sorted({int(i) for i in ids if i % every == 0}):
        own = min(tuple(v) for v in x[ids == q])
        far = {}
        for i, d in zip(ids.tolist(), np.sqrt(((x - np.array(own)) ** 2).sum(1)).tolist()):
            if i != q:
                far[i] = min(d, far.get(i, d))
        out[q] = sorted((d, i) for i, d in far.items())[:k]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 1, "x", 2) for i, v in rows], SCHEMA)


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 6)) * 4
    good = [(i, centres[i % 20] + rng.normal(size=6)) for i in range(1500)]
    good += [(5000 + i, np.ones(6)) for i in range(700)]  # one vector of many rows
    good += [(100, np.zeros(6) + 9.0), (100, np.zeros(6) + 9.5), (7, good[7][1])]  # repeated ids
    bad = [(200000, None), (200100, np.zeros(6)), (200200, [1, 2, None, 4, 5, 6]), (200300, [float("nan")] * 6)]
    bad += [(200400, [float("inf"), 0, 0, 0, 0, 1]), (200500, [1.0, 2.0]), (200600, []), (None, np.ones(6) * 2)]
    return [(i, [float(np.float32(c)) for c in v]) for i, v in good], bad


def test_recall_and_exact_distances(spark, table):
    good, bad = table
    got = {}
    for r in kt.search(frame(spark, good + bad), sample=600, bin_rows=200).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    want = brute(good, 100, 10)
    assert set(got) == set(want)
    hits = total = 0
    for q, rows in got.items():
        rows.sort()
        assert [n for n, _, _ in rows] == list(range(1, 11))
        assert [(d, i) for _, d, i in rows] == sorted((d, i) for _, d, i in rows)
        hits += len({i for _, _, i in rows} & {i for _, i in want[q]})
        total += 10
    assert hits >= 0.9 * total
    # queries whose ten nearest are copies of the common vector: ties go to the smaller ids
    for q in (5000, 5100):
        assert [(d, i) for _, d, i in got[q]] == want[q]


def test_exact_scan_matches_brute_force(spark, table):
    good, _ = table
    want = brute(good, 100, 10)
    asked = [(q, np.array(min(tuple(v) for i, v in good if i == q))) for q in want]
    got = {}
    for r in kt.exact(kt.usable(frame(spark, good), "vec_id", "embedding"), asked, 10).collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert {q: [i for _, i in sorted(v)] for q, v in got.items()} == {q: [i for _, i in v] for q, v in want.items()}
    assert all([d for d, _ in sorted(v)] == pytest.approx([d for d, _ in want[q]]) for q, v in got.items())


def test_few_and_no_rows(spark):
    few = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [5.0, 0.0])]
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in kt.search(frame(spark, few)).collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 4.0)]
    assert kt.search(frame(spark, [])).collect() == []
    assert kt.search(frame(spark, [(0, None), (1, [0.0])])).collect() == []
    assert kt.search(frame(spark, few[:1])).collect() == []


def test_visits_reach_every_leaf_once():
    points = np.random.default_rng(1).normal(size=(900, 5))
    tree = kt.Tree.fit(points, leaf_size=20)
    assert sorted(tree.visits(points[0])) == list(range(tree.leaves))
    first = [next(tree.visits(p)) for p in points]
    assert np.mean(np.array(first) == tree.assign(points)) > 0.9


def test_one_id_that_fills_the_nearest_leaves(spark):
    """Thousands of rows of one id around a query leave room for nine others."""
    rng = np.random.default_rng(9)
    good = [(7, rng.normal(size=4)) for _ in range(3000)] + [(100, np.zeros(4) + 0.01)]
    good += [(1000 + i, rng.normal(size=4) * 0.1 + 40 + i) for i in range(1, 30)]
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in good]
    got = {}
    for r in kt.search(frame(spark, rows), k=10).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    found = [vec for _, vec in sorted(got[100])]
    assert found[0] == 7 and len(found) == 10 and len(set(found)) == 10
