"""Scalar functions on literal rows: NULLs, edges, bad input."""

from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import calendar, credit, nulls, periods, stats
from ledgerloom.functions import text as txt
from ledgerloom.plans.batch_variance import direction, shown_pct
from tests.conftest import values


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "dpd, suffix",
    [(-5, "aboc"), (0, "aboc"), (1, "b001"), (15, "b001"), (16, "b016"), (30, "b016"), (31, "b031"), (60, "b031"),
     (61, "b061"), (990, "b961"), (991, "b991"), (1020, "b991"), (1021, "b1021"), (1080, "b1051"), (1081, "b1081"), (None, "")],
)
def test_bucket_edges(spark, dpd, suffix):
    assert one(spark, credit.dpd_bucket(F.lit("CD"), F.lit(dpd).cast("int"))) == f"CD-{suffix}"


def test_buckets_are_complete_and_monotone(spark):
    got = spark.range(-40, 1300).select(credit.bucket_suffix(F.col("id").cast("int")).alias("b"), credit.bucket_rank(credit.bucket_suffix(F.col("id").cast("int"))).alias("r"), "id").orderBy("id").collect()
    ranks = [r["r"] for r in got if r["id"] > 0]
    assert ranks == sorted(ranks) and len({r["b"] for r in got}) == 39


def test_bucket_rank(rows):
    df = rows("c string", ("CD-abnc",), ("CD-aboc",), ("CD-b016",), ("CLW-b1081",), (None,))
    assert [r[0] for r in df.select(credit.bucket_rank(F.col("c"))).collect()] == [1, 2, 16, 1081, None]


def test_stage_waterfall(rows):
    df = rows("dpd int, covid boolean, given string", (91, False, None), (90, False, "stage 1"), (31, False, None), (30, True, "stage 1"), (30, False, None), (5, False, "stage 2"), (None, False, None), (None, True, None))
    out = [r[0] for r in df.select(credit.stage(F.col("dpd"), F.col("covid"), F.col("given"))).collect()]
    assert out == ["stage 3", "stage 2", "stage 2", "stage 2", "stage 1", "stage 2", "stage 1", "stage 2"]


def test_rate_key(rows):
    df = rows("m string, t string, c string", ("REL", "CC_CLX", "REL-b031"), ("REL", None, "REL-b031"), ("REL", "X", None), ("CD", "CC_CLX", "CD-b001"), (None, None, "CD-b001"))
    out = [r[0] for r in df.select(credit.rate_key(F.col("m"), F.col("t"), F.col("c"))).collect()]
    assert out == ["CC_CLX-b031", "CC_CD-b031", "CC_CD", "CD-b001", "CD-b001"]


def test_movement_class(rows):
    df = rows("c string, p double, q double", (None, None, 5.0), ("x", 5.0, 2.0), ("x", 5.0, 7.0), ("x", 5.0, 5.0), ("x", 5.0, None), ("x", None, None))
    out = [r[0] for r in df.select(credit.movement_class(F.col("c"), F.col("p"), F.col("q"))).collect()]
    assert out == ["New_WD", "Recovery", "Additional WO", "No adj", "Recovery", "No adj"]


def test_balance_keeps_null_source_and_exposure_propagates(rows):
    df = rows("s double, a double, r double", (10.0, None, 3.0), (None, 1.0, 1.0), (10.0, 2.0, None))
    assert [r[0] for r in df.select(credit.net_balance(F.col("s"), F.col("a"), F.col("r"))).collect()] == [7.0, None, 12.0]
    assert [r[0] for r in df.select(credit.exposure(F.col("s"), F.col("a"), F.col("r"))).collect()] == [None, None, None]


def test_months(spark):
    assert periods.shift_literal("2021.12", 1) == "2022.01" and periods.shift_literal("2022.01", -1) == "2021.12"
    assert periods.trailing_months("2022.02", 4) == ["2022.02", "2022.01", "2021.12", "2021.11"]
    assert one(spark, periods.shift_month(F.lit("2022.01"), -1, ".")) == "2021.12"
    assert one(spark, periods.month_end("2020.02")) == date(2020, 2, 29)
    assert one(spark, periods.previous_month_end("2022.01")) == date(2021, 12, 31)


def test_period_text(rows):
    df = rows("p string", ("1-24",), (" 12-24 ",), ("total",), ("1-2-3",), (None,))
    assert [r[0] for r in df.select(periods.parse_mm_yy(F.col("p"))).collect()] == ["2024-01", "2024-12", None, None, None]


def test_null_helpers(rows):
    df = rows("a string, b string", ("x", None), (None, None))
    assert [r[0] for r in df.select(nulls.concat_blank(F.col("a"), F.lit("-"), F.col("b"))).collect()] == ["x-", "-"]
    nums = rows("v string", (" 1,234.5 ",), ("n/a",), (None,), ("-",))
    assert [r[0] for r in nums.select(nulls.strip_thousands(F.col("v"))).collect()] == [1234.5, None, None, None]
    pre = rows("v string", ("99A",), ("A99",), (None,))
    assert [r[0] for r in pre.select(nulls.not_prefixed(F.col("v"), "99")).collect()] == [False, True, True]
    div = rows("a double, b double", (1.0, 0.0), (1.0, 4.0), (1.0, None))
    assert [r[0] for r in div.select(nulls.safe_pct(F.col("a"), F.col("b"))).collect()] == [None, 25.0, None]
    nan = rows("v double", (float("nan"),), (1.0,))
    assert [r[0] for r in nan.select(nulls.nan_to_null(F.col("v"))).collect()] == [None, 1.0]


def test_text_helpers(rows):
    df = rows("t string", ("no. 12 of 34",), ("none",), (None,))
    assert [r[0] for r in df.select(txt.first_group(F.col("t"), r"(\d+)")).collect()] == ["12", None, None]
    assert [r[0] for r in df.select(txt.distinct_matches(F.col("t"), r"(\d)")).collect()] == [4, None, None]
    assert [r[0] for r in df.select(txt.matches_any(F.col("t"), "OF|NONE")).collect()] == [True, True, False]
    codes = rows("c string", ("BVXX",), ("zz",), (None,))
    assert [r[0] for r in codes.select(txt.code_group(F.col("c"), {"H": ["BVXX"]})).collect()] == ["H", "OTHER", "OTHER"]


def test_calendar_and_log_floor(rows):
    df = rows("d date, v double", (date(2021, 8, 1), 0.0), (date(2022, 8, 1), 2.0), (date(2020, 2, 1), None), (date(2020, 12, 1), -1.0))
    cols = calendar.calendar_columns(F.col("d"))
    out = df.select(*[cols[c].alias(c) for c in ("covid_dip", "yearend", "tet_feb")]).collect()
    assert [tuple(r) for r in out] == [(1, 0, 0), (0, 0, 0), (0, 0, 1), (0, 1, 0)]
    logs = [r[0] for r in df.select(calendar.log_floor(F.col("v"), 0.1)).collect()]
    assert logs[2] is None and logs[0] == logs[3] == pytest.approx(np.log(0.1)) and logs[1] == pytest.approx(np.log(2))


def test_direction(rows):
    df = rows("v double", (0.2,), (0.1,), (-0.1,), (-0.11,))
    assert [r[0] for r in df.select(direction(F.col("v"))).collect()] == ["OVER", "ON PLAN", "ON PLAN", "UNDER"]
    assert [r[0] for r in df.select(shown_pct(F.col("v") / 20)).collect()] == [0.01, 0.0, 0.0, 0.0]


def test_tails_against_known_values(spark):
    # textbook quantiles of the t and F distributions
    assert stats.t_quantile(0.975, 10) == pytest.approx(2.228139, abs=1e-6)
    assert stats.t_two_sided(2.228139, 10) == pytest.approx(0.05, abs=1e-6)
    assert stats.t_two_sided(0.0, 5) == 1.0
    assert stats.f_tail(3.708265, 3, 10) == pytest.approx(0.05, abs=1e-6)
    df = spark.createDataFrame([(1.0, 1.0), (None, 3.0), (2.0, 0.0)], "t double, n double")
    assert [r[0] for r in df.select(stats.t_pvalue("t", "n")).collect()] == [pytest.approx(0.5), None, None]


def test_values_helper(rows):
    assert values(rows("a int", (2,), (1,), (None,)))[0] == (None,)
