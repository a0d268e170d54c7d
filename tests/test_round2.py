"""Rules that were wrong once: sums at full scale, number texts, interval ends,
stability boundary, copies in the strict difference, dedup order, streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tierwise.functions import exprs as X
from tierwise.operators import blocks as B
from tierwise.operators import intervals as I
from tierwise.operators import merge as M
from tierwise.operators import reconcile as R
from tierwise.sources.catalog import TableSpec
from tierwise.sources.store import VersionedTable
from tierwise.session import scratch_path
from tierwise.streaming.incremental import incremental_ingest

TS = dt.datetime


def test_sums_keep_four_decimals(spark):
    df = spark.range(1000).select(F.lit("k").alias("k"), F.lit(TS(2024, 1, 5)).cast("timestamp_ntz").alias("d"), F.lit(0.004).alias("v"),
                                  F.lit("0.0004").cast("decimal(18,4)").alias("w"))
    assert float(B.monthly_sum(df, "k", "d", "v").first()["qty"]) == 4.0
    assert float(B.monthly_sum(df, "k", "d", "w").first()["qty"]) == 0.4
    r = R.control_totals(df, df.withColumn("v", F.col("v") + 0.0001), "d", "k", "v").first()
    assert r["sum_a"] == 4.0 and r["sum_diff"] == pytest.approx(-0.1)


def test_number_texts(spark):
    values = ["12D", "7f", "NaN", "Infinity", "1e30", "14.0", " 15 ", "-3.7", None, "12345678901234567890", "x1"]
    df = spark.createDataFrame([(v,) for v in values], "c string")
    assert [r[0] for r in df.select(X.int_text("c")).collect()] == ["12D", "7f", "NaN", "Infinity", "1e30", "14", "15", "-3", "", "12345678901234567890", "x1"]
    df = spark.createDataFrame([(v,) for v in ["12D", "12,5", "1.5", "NaN", None]], "c string")
    assert [r[0] for r in df.select(X.locale_decimal("c")).collect()] == [None, 12.5, 1.5, None, None]


def test_interval_ends_by_the_moment(spark):
    rates = spark.createDataFrame([("a", TS(2024, 1, 1), TS(2024, 1, 31), 5.0), ("a", TS(2024, 1, 10, 12), TS(2030, 1, 1), 2.0)], "k string, s timestamp_ntz, e timestamp_ntz, r double")
    readings = spark.createDataFrame([("a", TS(2024, 1, 31)), ("a", TS(2024, 1, 31, 10, 30)), ("a", TS(2024, 1, 10, 11)), ("a", TS(2024, 1, 10, 13)), ("a", TS(2024, 2, 1)),
                                      ("b", TS(2024, 1, 5))], "k string, t timestamp_ntz")
    got = {(r.k, r.t): float(r.rate) for r in I.interval_rate(readings, rates, "k", F.col("t"), "s", "e", "r").collect()}
    assert got == {("a", TS(2024, 1, 31)): 7, ("a", TS(2024, 1, 31, 10, 30)): 2, ("a", TS(2024, 1, 10, 11)): 5, ("a", TS(2024, 1, 10, 13)): 7,
                   ("a", TS(2024, 2, 1)): 2, ("b", TS(2024, 1, 5)): 0}


def test_stability_boundary(spark):
    df = spark.createDataFrame([(1, "D", TS(2024, 3, 8)), (2, "D", TS(2024, 3, 8, 1)), (3, "M", TS(2024, 2, 29)), (4, "M", TS(2024, 3, 1))], "i int, tag string, d timestamp_ntz")
    keep = R.stable_window("d", "2024-03-10 15:00:00", days=2, month_tags=["M"], tag_col="tag")
    assert sorted(r.i for r in df.where(keep).collect()) == [1, 3]


def test_strict_difference_of_many_copies(spark):
    a = spark.range(25_001).select(F.lit("x").alias("c"))
    d = R.symmetric_diff(a, spark.createDataFrame([("x",), ("y",)], "c string"), strict=True)
    assert {(r.c, r.side): r["count"] for r in d.groupBy("c", "side").count().collect()} == {("x", "only_in_a"): 25_000, ("y", "only_in_b"): 1}


def test_dedup_first_passes_single_keys_and_orders_text(spark):
    df = spark.createDataFrame([(1, "ab", "p"), (1, "abc", "q"), (1, None, "r"), (2, "z", "s"), (None, "a", "t"), (None, "b", "u")], "k int, o string, v string")
    assert sorted((r.k or 0, r.v) for r in M.dedup_first(df, "k", ["o"]).collect()) == [(0, "t"), (1, "p"), (2, "s")]
    assert sorted((r.k or 0, r.v) for r in M.dedup_first(df.where("o IS NOT NULL"), "k", ["o"], descending=True).collect()) == [(0, "u"), (1, "q"), (2, "s")]


def test_stream_refuses_a_keyless_table(spark):
    spec = TableSpec("v", None)
    root = scratch_path(spark, "keyless")
    with pytest.raises(ValueError):
        incremental_ingest(spark, spec, f"{root}/in", spark.range(1).schema, VersionedTable(spark, f"{root}/t"), "2024-01-01 00:00:00", f"{root}/c")
