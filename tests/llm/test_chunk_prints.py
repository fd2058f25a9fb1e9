import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import chunk_prints as cp
from ledgerloom.llm.queries import QUERIES
from tests.llm.edge import NASTY

SCHEMA = "doc_id bigint, text string, id string, part int, fingerprint string, hash string"


def hash_at(data, i):
    """Gear hash after byte i, one byte after the other."""
    h = 0
    for b in data[max(0, i - 31) : i + 1]:
        h = ((h << 1) + int(cp.GEAR[b])) % 2**32
    return h


def plain_bounds(data, by=cp.Chunking()):
    out, start, at = [], 0, 0
    while start < len(data):
        at = start + by.shortest
        while at < len(data):
            size = at - start
            bits = by.strict if size < by.normal else by.loose
            if size >= by.longest or hash_at(data, at - 1) >> (32 - bits) == 0:
                break
            at += 1
        at = min(at, len(data))
        while at < len(data) and data[at] & 0xC0 == 0x80:
            at += 1
        out.append(at)
        start = at
    return out


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefghiklmnoprstuéß", k=rng.randint(2, 9))) for _ in range(n))


@pytest.mark.parametrize("by", [cp.Chunking(), cp.Chunking(33, 64, 100, 6, 3)])
def test_bounds_byte_by_byte(monkeypatch, by):
    rng = random.Random(1)
    texts = ["", "a", "é" * 300, "x" * 2000, prose(rng, 900), "日本語🙂" * 200]
    for size in (4 << 20, 1000, 37):  # slabs of a text meet without a seam
        monkeypatch.setattr(cp, "SLAB", size)
        for t in texts:
            assert cp.bounds(t.encode(), by) == plain_bounds(t.encode(), by)


def test_edits_change_few_chunks():
    rng = random.Random(2)
    text = prose(rng, 3000)
    for at in rng.sample(range(len(text)), 10):
        for other in (text[:at] + "inserted" + text[at:], text[:at] + text[at + 5 :]):
            shared = cp.containment(cp.chunk_weights(text.encode()), cp.chunk_weights(other.encode()))
            assert 1 > shared > 0.9
    assert cp.containment(cp.chunk_weights(text.encode()), cp.chunk_weights(prose(rng, 3000).encode())) < 0.01
    sizes = [b - a for a, b in zip([0, *cp.bounds(text.encode())], cp.bounds(text.encode()))]
    assert min(sizes[:-1]) >= 32 and max(sizes) < 516 and 100 < sum(sizes) / len(sizes) < 200


def test_containment_and_text_form():
    a, b = {"aa": 10, "bb": 30}, {"bb": 7, "cc": 100}
    assert cp.containment(a, b) == 0.75 and cp.containment(b, a) == 7 / 107
    assert (cp.containment({}, {}), cp.containment({}, a), cp.containment(a, {})) == (1.0, 0.0, 0.0)
    assert cp.parsed(cp.written(a)) == a and cp.parsed(cp.written({})) == {}
    with pytest.raises(ValueError):
        cp.Chunking(16, 64, 128)


def expected(key, text, following):
    half = len(text) // 2
    edited = text[: len(text) - half] + following[:half]

    def weights(t):
        out, start, data = {}, 0, t.encode()
        for end in cp.bounds(data):
            k = hashlib.blake2b(data[start:end], digest_size=8).hexdigest()
            out[k] = out.get(k, 0) + len(data[start:end].decode())
            start = end
        return out

    def share(x, y):
        return sum(n for k, n in x.items() if k in y) / sum(x.values()) if x else float(not y)

    own, other, after = weights(text), weights(edited), weights(following)
    return (key, len(text), hashlib.sha256(edited.encode()).hexdigest(), own, other, share(own, other), share(own, after))


def result(df):
    found = [tuple(r) for r in df.collect()]
    return [(*r[:3], cp.parsed(r[3]), cp.parsed(r[4]), *r[5:]) for r in found]


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_next_row_across_ranges(spark, rows, parts):
    """Distinct ids in any order over more or fewer ranges than rows."""
    rng = random.Random(3)
    data = {i: prose(rng, rng.randint(0, 200)) for i in rng.sample(range(10**6), 25)}
    data[7], data[8] = None, data[min(data)]
    docs = rows(SCHEMA, *[(i, t, "x", 1, "y", "z") for i, t in rng.sample(sorted(data.items(), key=str), len(data))])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = result(cp.compare_with_next(docs))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    order = sorted(data, reverse=True)
    want = [expected(i, data[i] or "", data[order[(n + 1) % len(order)]] or "") for n, i in enumerate(order)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_odd_rows(rows, spark):
    """Every row has one result; the next row of each lies in the stated order."""
    nasty = NASTY + [(42, "very long é " * 1_700_000)] + [(None, "hot id")] * 30 + [(3, f"t{i}") for i in range(30)]
    docs = rows(SCHEMA, *[(i, t, "x", 1, "y", "z") for i, t in nasty])
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).withColumn("h", F.xxhash64("t"))
    order = [(r.doc_id, r.t) for r in keyed.orderBy(F.desc_nulls_last("doc_id"), "h", "t").collect()]
    want = [expected(i, t, order[(n + 1) % len(order)][1]) for n, (i, t) in enumerate(order)]
    assert sorted(result(cp.compare_with_next(docs)), key=str) == sorted(want, key=str)
    plain = [(r.id, r.n_chars, cp.parsed(r.fingerprint)) for r in cp.fingerprints(docs).collect()]
    assert sorted(plain, key=str) == sorted([(w[0], w[1], w[3]) for w in want], key=str)


def test_one_row_and_none(rows):
    got = result(cp.compare_with_next(rows(SCHEMA, (1, "alone", "x", 1, "y", "z"))))
    assert got == [expected(1, "alone", "alone")] and got[0][6] == 1.0
    empty = cp.compare_with_next(rows(SCHEMA))
    assert empty.collect() == [] and empty.columns[0] == "id" and cp.fingerprints(rows(SCHEMA)).collect() == []


def test_query_on_the_given_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    docs.sort(reverse=True)
    want = {i: expected(i, t, docs[(n + 1) % len(docs)][1]) for n, (i, t) in enumerate(docs)}
    got = result(QUERIES["op13_chunk_prints"](spark, folder))
    assert len(got) == len(docs) and all(r == want[r[0]] for r in got)
    near = sum(r[5] for r in got) / len(got)
    assert near > 0.3 > 0.05 > sum(r[6] for r in got) / len(got)
