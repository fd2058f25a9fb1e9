from collections import Counter

import pytest

from ledgerloom.llm import mixing
from tests.llm.edge import NASTY


@pytest.mark.parametrize("slots", [{"a": 1, "b": 1}, {"a": 5, "b": 3, "c": 2}, {f"s{i}": 1 + i * i for i in range(9)}, {"a": 997, "b": 1, "c": 2}])
def test_schedule_stays_within_a_block(slots):
    order, period, got = mixing.schedule(slots), sum(slots.values()), Counter()
    for t, (source, i) in enumerate(order, 1):
        assert i == got[source]
        got[source] += 1
        assert all(abs(got[s] - t * a / period) < 1 for s, a in slots.items())
    assert got == slots


def test_shares():
    assert sum(mixing.shares({"a": 0.7, "b": 0.2, "c": 0.1, "tiny": 1e-9}, 100).values()) == 100
    assert mixing.shares({"a": 3, "b": 1}, 8) == {"a": 6, "b": 2} or mixing.shares({"a": 3, "b": 1}, 8)["b"] >= 1
    with pytest.raises(ValueError):
        mixing.shares({"a": 1, "b": 0}, 10)


def rows_of(spark):
    rows = [(i, f"text {i}", "hot" if i % 3 == 0 else f"s{i % 5}", 1) for i in range(900)]
    rows += [(i, t, None if (i or 0) % 2 else "s1", 2) for i, t in NASTY]
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string, source string, slot int")


def test_mix_follows_the_weights(spark):
    rows, docs = rows_of(spark)
    weights = {"hot": 2, "": 1, **{f"s{i}": 3 for i in range(5)}}
    got = mixing.slotted(docs, weights, period=40, block=4).collect()
    assert len(got) == len(rows) and Counter(r.source for r in got) == Counter(r[2] or "" for r in rows)
    blocks = {}
    for r in got:
        blocks.setdefault((r.source, r.block), set()).add(r.slot)
    assert all(len(s) == 1 for s in blocks.values()) and len({min(s) for s in blocks.values()}) == len(blocks)
    places = {}
    for r in got:
        places.setdefault((r.source, r.block), []).append(r.place)
    last = {s: max(b for t, b in blocks if t == s) for s, _ in blocks}
    assert all(sorted(p) == list(range(len(p))) and (len(p) == 4 or b == last[s]) for (s, b), p in places.items())
    share = mixing.shares(weights, 40)
    horizon = len({r.slot for r in got if r.on_target})
    assert all(r.on_target == (r.slot < horizon) for r in got) and horizon not in {r.slot for r in got}
    order = sorted((min(s), key[0]) for key, s in blocks.items())
    seen = Counter()
    for t, (slot, source) in enumerate(order[: horizon], 1):
        seen[source] += 1
        assert slot == t - 1 and all(abs(seen[s] - t * a / 40) < 1 for s, a in share.items())


def test_rows_come_in_the_order_of_the_mix(spark):
    rows, docs = rows_of(spark)
    order = sorted(((r.slot, r.place), r.id) for r in mixing.slotted(docs, period=40, block=4).collect())
    out = mixing.mix(docs, partitions=3, period=40, block=4)
    assert out.columns == docs.columns
    got = out.collect()
    ids = [r.doc_id for r in got]
    assert len(got) == len(rows) and Counter(ids) == Counter(r[0] for r in rows)
    known = {i for i, n in Counter(ids).items() if n == 1 and i is not None}
    assert [i for i in ids if i in known] == [i for _, i in order if i in known]


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert mixing.slotted(docs).collect() == [] and mixing.mix(docs).collect() == []


WEIGHTS = [
    {f"s{i}": 0.9 if i == 0 else 0.1 / 99 for i in range(100)},
    {f"s{i}": 0.5 if i == 0 else 0.025 for i in range(21)},
    {"hot": 300**0.5, **{f"s{i}": 30**0.5 for i in range(20)}},
    {f"web{i}.example": 1.0 + i % 7 for i in range(1500)},
]


@pytest.mark.parametrize("weights", WEIGHTS)
def test_raw_weights_hold_over_many_slots(weights):
    """Deviation from the weights as given, with none rounded to a period."""
    total, got, slots = sum(weights.values()), Counter(), 8000
    dealing = mixing.deal(weights, dict.fromkeys(weights, slots))
    for t, (source, i, slot, on_target) in zip(range(1, slots + 1), dealing):
        assert on_target and slot == t - 1 and i == got[source]
        got[source] += 1
        if t % 7 == 0 or t > slots - 50:
            assert all(abs(got[s] - t * w / total) < 1 + 1e-9 for s, w in weights.items())
    assert got.total() == slots


def test_every_block_is_dealt_after_a_source_ends():
    blocks = {"a": 3, "b": 200, "c": 1}
    out = list(mixing.deal({"a": 0.3, "b": 1e-9, "c": 0.7}, blocks))
    assert Counter(s for s, *_ in out) == blocks and len({slot for _, _, slot, _ in out}) == len(out)
    assert [i for s, i, *_ in out if s == "b"] == list(range(200))
    ends = sum(on for *_, on in out)
    assert all((slot < ends) == on for _, _, slot, on in out) and ends not in {slot for _, _, slot, _ in out}


def test_slots_of_the_table_follow_the_raw_weights(spark):
    docs = spark.range(8000).selectExpr("id AS doc_id", "if(id % 2 = 0, 'big', concat('s', id % 40)) AS source")
    weights = {"big": 0.5, **{f"s{i}": 0.025 for i in range(1, 40, 2)}}
    order = sorted((r.slot, r.source) for r in mixing.slotted(docs, weights, block=1).collect() if r.on_target)
    seen = Counter()
    for t, (_, source) in enumerate(order, 1):
        seen[source] += 1
        assert abs(seen["big"] - t / 2) < 1
    assert len(order) >= 3000


def test_more_sources_than_a_thousand(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('web', id % 1500) AS source")
    got = mixing.slotted(docs, block=1).collect()
    assert sorted(r.id for r in got) == list(range(3000)) and len({r.slot for r in got}) == 3000
    firsts = sorted((r.slot, r.source) for r in got)[:1500]
    assert len({s for _, s in firsts}) == 1500
