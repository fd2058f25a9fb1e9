import numpy as np
import pytest

from ledgerloom.operators import cluster as km


def frame(spark, x, extra=()):
    rows = [(i, *map(float, p)) for i, p in enumerate(x)] + list(extra)
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"f{i} double" for i in range(x.shape[1])))


def scaled(x):
    s = x.std(0)
    return (x - x.mean(0)) / np.where(s > 0, s, 1)


def blobs(n=240, seed=3):
    rng = np.random.default_rng(seed)
    return rng.permutation(np.concatenate([rng.normal(c, 0.4, (n // 4, 2)) for c in ([0, 0], [6, 0], [0, 6], [6, 7])]))


def inertia(z, labels):
    return sum(((z[labels == c] - z[labels == c].mean(0)) ** 2).sum() for c in np.unique(labels))


def silhouette(z, labels):
    """Mean silhouette from all pairs, squared Euclidean distance."""
    far = ((z[:, None] - z[None]) ** 2).sum(2)
    out = []
    for i, c in enumerate(labels):
        own = labels == c
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = far[i, own].sum() / (own.sum() - 1)
        b = min(far[i, labels == o].mean() for o in np.unique(labels) if o != c)
        out.append((b - a) / max(a, b))
    return np.mean(out)


def plain_kmeans(z, k, starts, seed=0):
    """Best inertia of Lloyd's algorithm with k-means++ starts."""
    rng = np.random.default_rng(seed)
    best = np.inf
    for _ in range(starts):
        c = z[rng.integers(len(z))][None]
        while len(c) < k:
            d = ((z[:, None] - c[None]) ** 2).sum(2).min(1)
            c = np.vstack([c, z[rng.choice(len(z), p=d / d.sum())]])
        for _ in range(200):
            near = ((z[:, None] - c[None]) ** 2).sum(2).argmin(1)
            c = np.array([z[near == j].mean(0) if (near == j).any() else c[j] for j in range(k)])
        best = min(best, ((z[:, None] - c[None]) ** 2).sum(2).min(1).sum())
    return best


def test_inertia_and_silhouette_by_brute_force(spark):
    x = blobs()
    z = scaled(x)
    table, rows = km.sweep(frame(spark, x).repartition(5), ["f0", "f1"], ["id"], (2, 3, 4, 5), starts=12)
    got = {r.k: r for r in table.collect()}
    placed = {r.id: r for r in rows.collect()}
    assert len(placed) == len(x)
    for k in (2, 3, 4, 5):
        labels = np.array([placed[i][f"cluster_k{k}"] for i in range(len(x))])
        assert got[k].inertia == pytest.approx(inertia(z, labels), rel=1e-6)
        assert got[k].silhouette == pytest.approx(silhouette(z, labels), rel=1e-6)
        assert got[k].inertia <= plain_kmeans(z, k, 12) * 1.01  # other starts, other local optima
    assert [k for k in got if got[k].is_best] == [4]


def test_passes_are_shared(spark):
    x = blobs()
    rows = frame(spark, scaled(x)).selectExpr("f0 as x0", "f1 as x1", "xxhash64(id) as u")
    counts = {}
    for starts in (1, 15):
        job = km.Sweep(rows, 2, 42)
        first = job.starts(starts, 5)
        assert job.passes == 5 and first.shape == (starts, 5, 2)
        sets = [first[s, :k].copy() for k in (3, 5) for s in range(starts)]
        alone = []
        for s in sets:  # the longest run, counted one by one
            one = km.Sweep(rows, 2, 42)
            one.run([s.copy()], 100, 1e-4)
            alone.append(one.passes)
        job.passes = 0
        job.run(sets, 100, 1e-4)
        counts[starts] = job.passes
        assert job.passes == max(alone)


def test_seeds_follow_squared_distance(spark):
    """Second centres of many starts: the two far points are drawn in proportion to their squared distance."""
    x = np.concatenate([np.zeros((50, 1)), [[1.0]], [[2.0]]])
    rows = spark.createDataFrame([(float(v[0]), i) for i, v in enumerate(x)], "x0 double, i long").selectExpr("x0", "xxhash64(i) as u")
    first = km.Sweep(rows, 1, 1).starts(600, 2)
    from_zero = first[first[:, 0, 0] == 0][:, 1, 0]
    assert set(from_zero) == {1.0, 2.0} and len(from_zero) > 500
    assert (from_zero == 2.0).mean() == pytest.approx(0.8, abs=0.06)


def test_missing_values_repeated_rows_and_too_many_clusters(spark):
    x = np.array([[0.0, 0.0]] * 20 + [[5.0, 5.0]] * 10)
    df = frame(spark, x, [(100, None, 1.0), (101, float("nan"), 1.0)])
    table, rows = km.sweep(df.filter("id < 100 or id = 100"), ["f0", "f1"], ["id"], (2, 3), starts=2)
    got = {r.k: r for r in table.collect()}
    placed = {r.id: r.cluster_k2 for r in rows.collect()}
    assert placed[100] is None and len({placed[i] for i in range(20)}) == 1 and placed[0] != placed[25]
    assert got[2].inertia < 1e-9 and got[3].inertia < 1e-9 and got[2].silhouette == pytest.approx(1.0)
    with pytest.raises(ValueError):
        km.sweep(df.filter("id < 0"), ["f0", "f1"], ["id"])


def test_a_pass_is_matrix_products():
    """Costs, rows and sums of all sets as by plain distances, in less than half of their time."""
    import time

    rng = np.random.default_rng(0)
    x = rng.normal(size=(6000, 28))
    x[:50] = x[50:100]  # repeated rows
    sets = [rng.normal(size=(k, 28)) for k in (3, 4, 5) for _ in range(20)]
    first = np.cumsum([0] + [len(c) * 29 + 1 for c in sets])

    def plain():
        total = np.zeros(first[-1])
        for c, start in zip(sets, first):
            far = km._distances(x, c)
            near = far.argmin(axis=1)
            total[start] = far.min(axis=1).sum()
            total[start + 1 : start + 1 + c.size + len(c)] = np.column_stack(
                [np.bincount(near, minlength=len(c)), *[np.bincount(near, x[:, j], len(c)) for j in range(28)]]
            ).ravel()
        return total

    def products():
        total = np.zeros(first[-1])
        km._assigned(sets, first)(x, total)
        return total

    assert products() == pytest.approx(plain(), rel=1e-9, abs=1e-8)
    times = {}
    for f in (plain, products):
        began = time.process_time()
        for _ in range(3):
            f()
        times[f.__name__] = time.process_time() - began
    assert times["products"] < times["plain"] / 2, times
