"""Stored monthly tables: bucketed history, updates of touched months, reuse by fingerprint, rejected lines."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import provision, receivables
from ledgerloom.sources import history, sinks, tables
from tests.conftest import values
from tests.test_plans import provision_book

KEY = "skp_credit_case"
OVERVIEW = "skp_credit_case long, v int, mo string"


@pytest.fixture
def no_broadcast(spark):
    """Plans as for large tables."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, -1)
    yield
    spark.conf.set(name, before)


@pytest.fixture
def table(spark):
    names = []

    def new():
        names.append("t" + uuid.uuid4().hex)
        return names[-1]

    yield new
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {n}")


def bucketed_book(rows, table, tmp_path, buckets=4):
    overview, contract, application, rates, writeoff = provision_book(rows)
    path = lambda n: str(tmp_path / n)
    return (
        history.write_bucketed(overview, table(), KEY, buckets, path("overview"), "mo"),
        history.write_bucketed(contract, table(), KEY, buckets, path("contract")),
        history.write_bucketed(application, table(), KEY, buckets, path("application")),
        rates,
        history.write_bucketed(writeoff, table(), KEY, buckets, path("writeoff")),
    )


def test_movement_on_bucketed_history_moves_no_row(rows, table, tmp_path, no_broadcast):
    """No exchange by contract lies under the full outer join; the rate table (a row per product, bucket and month) is broadcast."""
    book = list(bucketed_book(rows, table, tmp_path))
    book[3] = F.broadcast(book[3])
    plain = provision.provision_movement(*provision_book(rows), "2021.11", "2021.12")
    found = provision.provision_movement(*book, "2021.11", "2021.12", match=KEY)
    assert values(found.select(plain.columns)) == values(plain)
    assert history.shuffles(found) == []
    usual = provision.provision_movement(*provision_book(rows), "2021.11", "2021.12")
    assert any("text_contract_number" in line for line in history.shuffles(usual))
    with pytest.raises(ValueError):
        provision.provision_movement(*book, "2021.11", "2021.12", match="mo")


def test_month_against_month_join_without_exchange(spark, rows, table, tmp_path, no_broadcast):
    df = rows(OVERVIEW, *[(i, i % 7, f"2022.0{m}") for i in range(200) for m in (1, 2, 3) if (i + m) % 5])
    stored = history.write_bucketed(df, table(), KEY, 8, str(tmp_path / "h"), "mo")
    both = stored.filter("mo = '2022.01'").join(stored.filter("mo = '2022.02'").withColumnRenamed("v", "w"), KEY, "full_outer")
    assert history.shuffles(both) == [] and both.count() == df.filter("mo < '2022.03'").select(KEY).distinct().count()
    latest = stored.groupBy(KEY).agg(F.max("mo"))
    assert history.shuffles(latest) == []


def test_reload_keeps_the_layout(spark, rows, table, tmp_path, no_broadcast):
    name, path = table(), str(tmp_path / "h")
    df = rows(OVERVIEW, *[(i, 0, f"2022.0{m}") for i in range(100) for m in (1, 2)])
    history.write_bucketed(df, name, KEY, 4, path, "mo")
    first = sorted(os.listdir(f"{path}/mo=2022.01"))
    times = [os.stat(f"{path}/mo=2022.01/{f}").st_mtime_ns for f in first]
    stored = history.reload_months(rows("mo string, v int, skp_credit_case long", *[("2022.02", 9, i) for i in range(50, 130)]), name, KEY, 4)
    assert sorted(os.listdir(f"{path}/mo=2022.01")) == first
    assert [os.stat(f"{path}/mo=2022.01/{f}").st_mtime_ns for f in first] == times
    assert stored.filter("mo = '2022.02'").count() == 80 and stored.filter("mo = '2022.01'").count() == 100
    assert len([f for f in os.listdir(f"{path}/mo=2022.02") if f.endswith(".parquet")]) == 4
    both = stored.filter("mo = '2022.01'").join(stored.filter("mo = '2022.02'").withColumnRenamed("v", "w"), KEY)
    assert history.shuffles(both) == [] and both.count() == 50
    again = history.attach_bucketed(spark, table(), "skp_credit_case long, v int, mo string", KEY, 4, path, "mo")
    assert values(again, KEY, "v", "mo") == values(stored, KEY, "v", "mo")
    assert history.shuffles(again.groupBy(KEY).count()) == []


def listing(path):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")
    }


STAGES = "skp_credit_case long, stage_split string, mo string"


def stored_stages(spark, rows, path):
    df = rows(
        STAGES, (1, "stage 1", "2022.01"), (2, "stage 2", "2022.01"), (1, "stage 1", "2022.02"), (3, "stage 1", "2022.02"),
        (4, "stage 2", "2022.03"), (1, "stage 2", "2022.03"), (5, "stage 1", None), (6, "stage 1", None),
    )
    sinks.replace_months(df, path)
    return spark.read.schema(df.schema).parquet(path)


def update(spark, target, path, keys, swap=None):
    matches = spark.createDataFrame([(k,) for k in keys], "skp_credit_case long")
    swap = swap or (lambda new: sinks.replace_months(new, path))
    return sinks.update_stored(target, matches, [KEY], {"stage_split": F.lit("new")}, swap, F.col("stage_split") == "stage 1")


def test_only_touched_months_are_rewritten(spark, rows, tmp_path):
    path = str(tmp_path / "stages")
    target = stored_stages(spark, rows, path)
    before = listing(path)
    expected = sinks.update_matched(
        target, rows("skp_credit_case long", (3,), (4,), (3,)), [KEY], {"stage_split": F.lit("new")}, F.col("stage_split") == "stage 1"
    )
    want = values(expected, *target.columns)
    assert update(spark, target, path, [3, 4, 3, 99]) == ["2022.02"]
    after = listing(path)
    kept = {p: t for p, t in before.items() if "2022.02" not in p}
    assert {p: t for p, t in after.items() if "2022.02" not in p} == kept and len(kept) >= 3
    assert not {p for p in after if "2022.02" in p} & set(before)
    spark.catalog.refreshByPath(path)
    assert values(spark.read.schema(target.schema).parquet(path), *target.columns) == want


def test_rows_without_a_month_and_no_match(spark, rows, tmp_path):
    path = str(tmp_path / "stages")
    target = stored_stages(spark, rows, path)
    before = listing(path)
    assert update(spark, target, path, [4, 77]) == [] and listing(path) == before
    assert update(spark, target, path, [5, 1]) == [None, "2022.01", "2022.02"]
    spark.catalog.refreshByPath(path)
    back = values(spark.read.schema(target.schema).parquet(path))
    assert (5, "new", None) in back and (6, "stage 1", None) in back and (1, "stage 2", "2022.03") in back and len(back) == 8


def test_failure_before_the_swap_leaves_the_old_rows(spark, rows, tmp_path):
    path = str(tmp_path / "stages")
    target = stored_stages(spark, rows, path)
    before, old = listing(path), values(target)

    def broken(new):
        assert new.count() == 2  # the new rows are complete, and not in the store
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        update(spark, target, path, [3], broken)
    assert listing(path) == before and values(target) == old


def test_update_of_a_bucketed_table(spark, rows, table, tmp_path, no_broadcast):
    name = table()
    df = rows(STAGES, *[(i, "stage 1", f"2022.0{m}") for i in range(40) for m in (1, 2)])
    stored = history.write_bucketed(df, name, KEY, 4, str(tmp_path / "b"), "mo")
    one = rows("skp_credit_case long", (7,))
    months = sinks.update_stored(
        stored, one, [KEY], {"stage_split": F.lit("new")}, lambda new: history.reload_months(new, name, KEY, 4), F.col("mo") == "2022.02"
    )
    now = spark.table(name)
    assert months == ["2022.02"] and now.count() == 80 and values(now.filter("stage_split = 'new'"), KEY, "mo") == [(7, "2022.02")]
    assert history.shuffles(now.groupBy(KEY).count()) == []


def test_stored_overrides_equal_the_frame_ones(spark, rows, tmp_path):
    cols = "skp_credit_case long, stage_split string, mo string"
    overview = rows(cols, *[(i, f"stage {1 + i % 3}", m) for i in range(12) for m in ("2021.11", "2021.12")])
    industry = rows("skp_credit_case long, date_balance date, impact_by_covid int").union(
        spark.sql("SELECT id, DATE'2021-12-31', 1 FROM range(0, 8)")
    )
    writeoff = rows("skp_credit_case long, mo string", (3, "2021.12"), (4, "2022.01"), (3, "2021.10"))
    path = str(tmp_path / "o")
    sinks.replace_months(overview, path)
    stored = spark.read.schema(overview.schema).parquet(path)
    before = listing(path)
    months = receivables.override_stored_stages(stored, industry, writeoff, "2021.12", lambda new: sinks.replace_months(new, path))
    spark.catalog.refreshByPath(path)
    want = receivables.override_stages(overview, industry, writeoff, "2021.12")
    assert months == ["2021.12"] and values(spark.read.schema(overview.schema).parquet(path), KEY, "stage_split", "mo") == values(want, KEY, "stage_split", "mo")
    assert all(listing(path)[p] == t for p, t in before.items() if "2021.11" in p)


def test_reuse_follows_inputs_and_parameters(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "a.csv").write_text("x\n1\n")
    calls = []

    def build():
        calls.append(1)
        return spark.read.schema("x int").option("header", True).csv(str(source))

    def total(parameters=None, inputs=None):
        return sinks.reuse_or_build(spark, path, build, inputs or [str(source)], parameters).agg(F.sum("x")).first()[0]

    assert (total(), total(), len(calls)) == (1, 1, 1)
    (source / "a.csv").write_text("x\n20\n")  # other size
    assert (total(), len(calls)) == (20, 2)
    os.utime(source / "a.csv", (1, 1))  # other time
    assert (total(), len(calls)) == (20, 3)
    (source / "b.csv").write_text("x\n5\n")  # one more file
    assert (total(), len(calls)) == (25, 4)
    assert (total({"k": 1, "names": ["a"]}), len(calls)) == (25, 5)
    assert (total({"names": ["a"], "k": 1}), len(calls)) == (25, 5)
    assert (total({"k": 2, "names": ["a"]}), len(calls)) == (25, 6)
    os.remove(source / "b.csv")
    assert (total({"k": 2, "names": ["a"]}), len(calls)) == (20, 7)
    assert (total({}, [str(source), str(tmp_path / "absent")]), len(calls)) == (20, 8)


def test_reuse_starts_no_job_and_a_failed_build_leaves_no_manifest(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.reuse_or_build(spark, path, lambda: spark.range(3), [], {"v": 1})
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("reuse", "")
    again = sinks.reuse_or_build(spark, path, lambda: None, [], {"v": 1})
    assert list(tracker.getJobIdsForGroup("reuse")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert again.count() == 3
    with pytest.raises(RuntimeError):
        sinks.reuse_or_build(spark, path, lambda: (_ for _ in ()).throw(RuntimeError("x")), [], {"v": 2})
    assert sinks.reuse_or_build(spark, path, lambda: spark.range(5), [], {"v": 1}).count() == 5


def test_rejected_lines_of_a_folder(spark, tmp_path):
    (tmp_path / "m1.csv").write_bytes(
        "﻿month,sale,rate\n2020-01,5,1.5\n2020-02,6\n2020-03,7,1.0,extra\n2020-04,n/a,2.0\n2020-05,,\n".encode()
    )
    (tmp_path / "m2.csv").write_text('month,sale,rate\n"2020-06",8,2.5\n2020-07,9,"3.5\n"2020, 08",1,"2"\n')
    (tmp_path / "other.txt").write_text("month,sale,rate\nx,1,1\n")
    good, bad = tables.csv_checked(spark, str(tmp_path), "month string, sale double, rate double", "*.csv")
    assert values(good) == sorted([("2020, 08", 1.0, 2.0), ("2020-01", 5.0, 1.5), ("2020-05", None, None), ("2020-06", 8.0, 2.5)])
    found = {r.line: r for r in bad.collect()}
    assert set(found) == {"2020-02,6", "2020-03,7,1.0,extra", "2020-04,n/a,2.0", '2020-07,9,"3.5'}
    assert found["2020-02,6"].file == "m1.csv" and found["2020-04,n/a,2.0"].rate == 2.0 and found['2020-07,9,"3.5'].file == "m2.csv"
    lines = sum(len(open(tmp_path / f, encoding="utf-8-sig").read().splitlines()) - 1 for f in ("m1.csv", "m2.csv"))
    assert good.count() + bad.count() == lines
    narrow = good.select("month")
    assert narrow.count() == 4 and bad.select("line").count() == 4
