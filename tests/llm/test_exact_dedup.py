import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import exact_dedup as ed
from tests.llm.edge import NASTY

SCHEMA = "doc_id bigint, text string, id int, digest string, _path int, rows string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "d", 2, "r") for i, t in rows], SCHEMA)


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        same = groups[t or ""]
        keep = max(same, key=lambda x: (x is not None, x or 0))
        out.append((i, keep, len(same), hashlib.sha256((t or "").encode()).hexdigest()))
    return groups, sorted(out, key=str)


@pytest.mark.parametrize("weak", [False, True])
def test_against_brute_force(spark, weak):
    """With a digest of two bits nearly all texts collide; the full bytes have to tell them apart."""
    rows = NASTY + [(i, f"text {i % 7}") for i in range(60)]
    digest = (lambda t: F.substring(F.unhex(F.sha2(t, 256)), 1, 1).cast("binary")) if weak else ed.sha256
    got = ed.duplicate_groups(frame(spark, rows), digest=digest).collect()
    groups, want = brute(rows)
    if not weak:
        assert sorted(((r.id, r.keep_id, r.group_size, bytes(r.digest).hex()) for r in got), key=str) == want
    assert sorted(((r.id, r.keep_id, r.group_size) for r in got), key=str) == sorted((w[:3] for w in want), key=str)
    assert sum(r.kept for r in got) == len(groups) and all(r.id == r.keep_id for r in got if r.kept)


def test_rows_that_stay(spark):
    rows = NASTY + [(i, f"text {i % 7}") for i in range(60)]
    left = ed.drop_duplicates(frame(spark, rows))
    assert left.columns == ["doc_id", "text", "id", "digest", "_path", "rows"]
    groups, _ = brute(rows)
    assert sorted(left.select(F.coalesce("text", F.lit("")).alias("t")).collect()) == sorted((t,) for t in groups)


def test_empty(spark):
    assert ed.duplicate_groups(frame(spark, [])).collect() == []
    assert ed.drop_duplicates(frame(spark, [])).collect() == []
