import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import sketches as sk
from ledgerloom.sources import sinks
from tests.conftest import values


def usage(spark):
    """Three months whose batches overlap; one factory has most rows."""
    return spark.range(120_000).select(
        F.format_string("2022.%02d", F.col("id") % 3 + 1).alias("mo"),
        F.when(F.col("id") % 10 == 0, "F1").otherwise("F0").alias("factory"),
        (F.col("id") * 7919 % 40_009 + F.col("id") % 3 * 5000).alias("batch"),
        F.when(F.col("id") % 4 > 0, F.col("id") % 97).alias("item"),
    )


def test_union_over_months_is_within_its_error(spark):
    df = usage(spark)
    stored = sk.monthly_sketches(df, "mo", ["factory"], ["batch", "item"])
    assert stored.count() == 6
    for months in (None, F.col("mo") < "2022.03"):
        rows = df if months is None else df.filter(months)
        exact = {r.factory: r for r in rows.groupBy("factory").agg(F.count_distinct("batch").alias("b"), F.count_distinct("item").alias("i")).collect()}
        for r in sk.merged_counts(stored, ["factory"], ["batch", "item"], months).collect():
            assert r.approx_batch == pytest.approx(exact[r.factory].b, rel=sk.error_bound())
            assert r.approx_item == exact[r.factory].i  # few values are counted exactly
    whole = sk.merged_counts(stored, [], ["batch"]).first().approx_batch
    assert whole == pytest.approx(df.select("batch").distinct().count(), rel=sk.error_bound())


def test_reload_of_a_month_replaces_its_sketches(spark, tmp_path):
    path = str(tmp_path / "sketches")
    swap = lambda new: sinks.replace_months(new, path)
    df = usage(spark)
    sk.reload_sketches(df, "mo", ["factory"], ["batch"], swap)
    kept = {m: sorted(os.listdir(f"{path}/mo={m}")) for m in ("2022.01", "2022.03")}
    sk.reload_sketches(df.filter("mo = '2022.02'").withColumn("batch", F.lit(1)), "mo", ["factory"], ["batch"], swap)
    assert {m: sorted(os.listdir(f"{path}/mo={m}")) for m in kept} == kept
    back = spark.read.schema("factory string, sketch_batch binary, mo string").parquet(path)
    assert values(sk.merged_counts(back, ["factory"], ["batch"], F.col("mo") == "2022.02")) == [("F0", 1), ("F1", 1)]


def test_nulls_and_no_rows(rows):
    df = rows("mo string, g string, v int", ("a", "x", None), ("a", None, 1), ("b", None, 2), ("b", None, None))
    assert values(sk.merged_counts(sk.monthly_sketches(df, "mo", ["g"], ["v"]), ["g"], ["v"])) == [(None, 2), ("x", 0)]
    assert sk.merged_counts(sk.monthly_sketches(df.filter("false"), "mo", ["g"], ["v"]), ["g"], ["v"]).collect() == []
