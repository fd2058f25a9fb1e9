import zlib

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import toxicity as tox
from tests.llm.edge import NASTY


def corpus(n=1500, seed=4):
    rng = np.random.default_rng(seed)
    clean = [f"word{k}" for k in range(400)]
    bad = ["vile", "awful", "nasty", "rotten"]
    rows, labels = [], []
    for i in range(n):
        words = list(rng.choice(clean, rng.integers(20, 120)))
        toxic = rng.random() < 0.12
        if toxic:
            for w in rng.choice(bad, 3):
                words[rng.integers(len(words))] = str(w).title() + "!"
        rows.append((i, " ".join(words)))
        if rng.random() < 0.6:
            labels.append((i, int(toxic)))
    return rows, labels, {i for i, t in rows if any(b in t.lower() for b in bad)}


@pytest.fixture(scope="module")
def trained(spark):
    rows, labels, truth = corpus()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    table = spark.createDataFrame(labels + labels[:50] + [(None, 1), (3, None)], "doc_id bigint, toxic int")
    return docs, table, truth, tox.train(docs, table)


def test_held_out_documents_are_told_apart(spark, trained):
    docs, _, truth, model = trained
    got = tox.score(docs, model).withColumn("h", tox.held_out("doc_id")).collect()
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    hits = [(r.score >= tox.LIMIT, r.doc_id in truth) for r in got if r.h]
    assert sum(a and b for a, b in hits) >= 0.95 * sum(b for _, b in hits)
    assert sum(a and not b for a, b in hits) <= 0.02 * len(hits)


def test_held_out_labels_are_not_used(spark, trained):
    docs, table, _, model = trained
    flipped = table.withColumn("toxic", __import__("pyspark.sql.functions", fromlist=["x"]).expr("if(crc32(cast(doc_id as string)) % 4 = 2, 1 - toxic, toxic)"))
    again = tox.train(docs, flipped)
    assert np.array_equal(again.weights, model.weights) and np.array_equal(again.bias, model.bias)


def test_nasty_rows_and_columns(spark, trained):
    model = trained[3]
    frame = spark.createDataFrame([(i, t, 0.5, "s") for i, t in NASTY], "doc_id bigint, text string, c0 double, scored string")
    got = tox.score(frame, model)
    assert got.columns == ["doc_id", "text", "c0", "scored", "score"] and got.count() == len(NASTY)
    assert all(0 <= r.score <= 1 and r.c0 == 0.5 for r in got.collect())
    empty = {r.score for r in got.collect() if not (r.text or "").strip()}
    assert len(empty) == 1
    assert tox.drop_toxic(frame, model).columns == frame.columns


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = tox.train(docs, labels)
    assert tox.score(docs, model).collect() == []
    some = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    assert tox.score(some, model).first().score == 0.0


def test_risk_cannot_be_driven_below_zero():
    """More unlabelled documents look like examples than the prior says: the clean part of the risk stays bounded."""
    positive = [np.array([1, 2]) for _ in range(50)]
    unlabelled = [np.array([1, 2]) for _ in range(40)] + [np.array([3]) for _ in range(160)]
    model = tox.fit(positive, unlabelled, prior=0.15, classifiers=1)
    p = model.score(np.array([1, 2, 3]), np.array([0, 2, 3]))
    assert p[0] > 0.5 > p[1] and np.isfinite(p).all()


def test_features_fold_case_and_punctuation():
    ids, first = tox.features(pa.array(["Bad, bad BAD", "bad", None]))
    assert np.array_equal(ids[first[0] : first[1]], ids[first[1] : first[2]]) and first[3] == first[2]
