import math
from fractions import Fraction

import numpy as np
import pytest

from ledgerloom.llm import bit_scatter as bs
from ledgerloom.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<double>, id int, v string, w string, at int"


def frame(rows, data):
    return rows(SCHEMA, *[(i, v, 1, "x", "y", 2) for i, v in data])


def truth(data, components=8):
    """Exact sums and covariance by fractions, eigenvectors of it in double."""
    x = [[math.floor(1024 * c) + 100000 for c in v] for _, v in data]
    n, d = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(d)]
    scatter = [[n * sum(r[i] * r[j] for r in x) - sums[i] * sums[j] for j in range(d)] for i in range(d)]
    e, axes = np.linalg.eigh(np.array([[float(Fraction(c, n * n)) for c in row] for row in scatter]))
    e, axes = e[::-1], axes[:, ::-1]
    trace = float(Fraction(sum(scatter[i][i] for i in range(d)), n * n))
    far = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(r, sums)] for r in x])
    deviation = [sum((n * c - s) ** 2 for c, s in zip(r, sums)) for r in x]
    k = min(components, d)
    return n, deviation, far @ axes[:, :k] / np.sqrt(e[:k]), e[:k] / trace


def compare(found, data):
    n, deviation, white, share = truth(data)
    got = {}
    for r in found:
        got.setdefault(r.id, {})[r.component] = r
    assert len(found) == len(data) * white.shape[1]
    signs = [np.sign(got[data[0][0]][c + 1].whitened * white[0, c]) for c in range(white.shape[1])]
    for row, (key, _) in enumerate(data):
        for c in range(white.shape[1]):
            r = got[key][c + 1]
            assert r.n == n and r.deviation == deviation[row]
            assert r.whitened * signs[c] == pytest.approx(white[row, c], rel=1e-9, abs=1e-9)
            assert r.explained == pytest.approx(share[c], rel=1e-10) and 0 <= r.identity_error < 1e-8


@pytest.mark.parametrize("slab", [64, 65, 1 << 14])
def test_against_fractions(rows, monkeypatch, slab):
    rng = np.random.default_rng(1)
    mix = rng.normal(size=(12, 12))
    data = [(i, (mix @ rng.normal(size=12) * 3 + np.arange(12)).tolist()) for i in range(400)]
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v in data])
    one = np.concatenate([np.ones((len(x), 1), int), x], axis=1).astype(object)
    monkeypatch.setattr(bs, "SLAB", slab)
    total = sum(bs.scatter(x[a : a + slab]) for a in range(0, len(x), slab))
    assert (total == one.T @ one).all()
    compare(bs.whiten(frame(rows, data)).collect(), data)


def test_wide_range_of_values(rows):
    """Products and sums beyond 64 bits stay exact."""
    rng = np.random.default_rng(2)
    data = [(i, [float(c) for c in rng.normal(size=3) * [1.0, 1e6, 1e12]]) for i in range(60)]
    n, deviation, _, share = truth(data)
    found = bs.whiten(frame(rows, data)).collect()
    assert {(r.id, r.deviation) for r in found} == {(i, d) for (i, _), d in zip(data, deviation)}
    assert max(deviation) > 2**100 and {r.component for r in found} == {1, 2, 3}


def test_rows_that_take_no_part(rows):
    rng = np.random.default_rng(3)
    good = [(i, rng.normal(size=4).tolist()) for i in range(50)] + [(900, [0.0] * 4), (901, [0.5] * 4)]
    bad = [(1000, None), (1001, [1.0, None, 2.0, 3.0]), (1002, [float("nan")] * 4), (1003, [1.0, float("inf"), 0.0, 0.0])]
    bad += [(1004, [1.0, 2.0]), (1005, []), (1006, [1e300, 0.0, 0.0, 0.0])]
    compare(bs.whiten(frame(rows, bad[:3] + good + bad[3:])).collect(), good)


def test_repeated_rows_and_missing_ids(rows):
    rng = np.random.default_rng(4)
    base = [(i, rng.normal(size=3).tolist()) for i in range(20)]
    found = bs.whiten(frame(rows, base + base + [(None, [0.1, 0.2, 0.3])] * 30)).collect()
    assert len(found) == 70 * 3 and sum(r.id is None for r in found) == 90 and {r.n for r in found} == {70}
    assert all(r.identity_error < 1e-10 for r in found)


def test_without_variance(rows):
    one = bs.whiten(frame(rows, [(1, [1.0, 2.0])])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(c, 1, 0, None, None, None) for c in (1, 2)]
    line = [(i, [float(i), 2.0 * i, 7.0]) for i in range(10)]
    found = sorted(bs.whiten(frame(rows, line)).collect(), key=lambda r: (r.component, r.id))
    assert [r.whitened is None for r in found] == [False] * 10 + [True] * 20
    assert found[0].explained == pytest.approx(1.0) and found[-1].explained == pytest.approx(0.0, abs=1e-12)


def test_empty_table(rows):
    for data in ([], [(1, None), (2, [])]):
        found = bs.whiten(frame(rows, data))
        assert found.collect() == [] and found.columns[:2] == ["id", "component"]


def test_query_on_the_given_table(spark):
    folder = "/root/testdata/sf0.001"
    data = [(r.vec_id, [float(c) for c in r.embedding]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    found = QUERIES["op11_whitening"](spark, folder).withColumnRenamed("vec_id", "id")
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]
    compare(found.collect(), data)
