import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import merkle
from tests.llm.edge import NASTY

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf int, grp string, path string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + arity])) for i in range(0, len(below), arity)])
    return levels


def siblings(levels, at, arity):
    out = []
    for level in levels[:-1]:
        start = at - at % arity
        run = level[start : start + arity]
        out.append(("".join(run[: at - start]), "".join(run[at - start + 1 :])))
        at //= arity
    return out


def brute(rows, arity):
    """Expected (id, leaf, subroot, root, path, folded root) with n_chars raised by one where the id is even."""
    groups = {}
    for r in rows:
        got = (*r[:3], r[3] + 1 if r[3] is not None else None, r[4]) if r[0] is not None and r[0] % 2 == 0 else r
        groups.setdefault(r[2], []).append((r[0], leaf_of(r), leaf_of(got)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    trees = {g: tree([r[1] for r in groups[g]], arity) for g in names}
    top = tree([trees[g][-1][0] for g in names], arity)
    out = []
    for i, g in enumerate(names):
        for at, (key, leaf, got) in enumerate(groups[g]):
            path = siblings(trees[g], at, arity) + siblings(top, i, arity)
            node = got
            for left, right in path:
                node = sha(left + node + right)
            out.append((key, leaf, trees[g][-1][0], top[-1][0], path, node))
    return out


def run(spark, rows, arity=2, height=3):
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)
    found = merkle.audit(docs, FIELDS, "lang", "doc_id", {"n_chars": F.col("n_chars") + 1}, F.col("doc_id") % 2 == 0, arity, height)
    return [(r.id, r.leaf, r.subroot, r.root, [tuple(s) for s in r.path], r.folded_root, r.verified) for r in found.collect()]


def check(spark, rows, arity=2, height=3):
    want = brute(rows, arity)
    want = [(*w, w[5] == w[3]) for w in want]
    key = lambda r: (r[0] is not None, r[0] or 0, str(r))
    assert sorted(run(spark, rows, arity, height), key=key) == sorted(want, key=key)
    return want


@pytest.mark.parametrize("arity,height", [(2, 3), (3, 2), (5, 1), (2, 6)])
def test_against_trees_built_by_hand(spark, arity, height):
    """Group sizes around every block edge, a group with most rows, a null group, text order of groups by bytes."""
    rng = random.Random(4)
    sizes = {None: 9, "a": 1, "b": 2, "": 7, "hot": 400, "Z": 8, "é": 65, "zz": 64, "😀": 3}
    rows = [(rng.randrange(10**6), f"s{i % 3}", g, rng.choice([None, 5, 123]), f"text {g} {i}") for g, n in sizes.items() for i in range(n)]
    rng.shuffle(rows)
    want = check(spark, rows, arity, height)
    assert {w[6] for w in want} == {True, False}


@pytest.mark.parametrize("size", [1, 2, 3, 8, 9])
def test_single_group(spark, size):
    want = check(spark, [(2 * i + 1, None, "en", 4, "t") for i in range(size)])
    assert all(w[6] for w in want) and (size > 1 or want[0][4] == [])


def test_odd_rows(spark):
    """Nulls everywhere, repeated rows and ids, odd texts, one very long text."""
    rows = [(i, None, "en" if (i or 0) % 3 else None, None if t is None else len(t), t) for i, t in NASTY]
    check(spark, rows + [(77, "s", "en", 20_000_000, "long é " * 3_000_000)] + [(None, None, None, None, None)] * 40)


def test_repeated_id_with_a_third_of_all_rows(spark):
    rows = [(5, "s", "en", 1, f"text {i}") for i in range(150)] + [(i, "s", "en", 1, "t") for i in range(300)]
    check(spark, rows + [(6, "s", "en", 1, "same")] * 150)


def test_empty_table(spark):
    assert run(spark, []) == []
    docs = spark.createDataFrame([], SCHEMA).select(F.lit("a").alias("grp"), F.col("doc_id").alias("id"), F.lit("x").alias("leaf"))
    assert merkle.build(docs, "id", ["id"]).root() is None


def test_any_change_is_found(spark):
    """Changing, swapping or dropping a row gives another root."""
    rows = [(i, "s", "en" if i % 2 else "fr", i, f"t{i}") for i in range(90)]

    def root(data):
        docs = spark.createDataFrame([(*r, 1, "x", "y") for r in data], SCHEMA)
        leaf = merkle.leaf_digest([F.col(f) for f in FIELDS])
        return merkle.build(docs.select(F.col("lang").alias("grp"), F.col("doc_id").alias("id"), leaf.alias("leaf")), "id", ["id"], height=2).root()

    first = root(rows)
    assert root(rows[::-1]) == first
    assert len({first, root(rows[:-1]), root(rows[:5] + [(5, "s", "en", 5, "u")] + rows[6:]), root(rows + rows[:1])}) == 4


def test_no_python_and_no_single_task(spark):
    docs = spark.createDataFrame([(i, "s", "en", 1, "t", 1, "x", "y") for i in range(300)], SCHEMA)
    plan = merkle.audit(docs, FIELDS, "lang", "doc_id")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
