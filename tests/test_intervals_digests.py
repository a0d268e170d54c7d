"""Rates by a sweep and differences by digests of key ranges."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from tierwise.operators import digests as D
from tierwise.operators import intervals as I
from tierwise.operators import merge as M
from tierwise.operators import reconcile as R

BASE = dt.datetime(2024, 1, 1)
READS = "k string, t timestamp_ntz, n int"
RATES = "k string, a timestamp_ntz, b timestamp_ntz, r decimal(12,3)"


def moment(rnd, span=90):
    return BASE + dt.timedelta(days=rnd.randrange(span), seconds=rnd.choice([0, 0, 1, 3600, 86399]))


@pytest.mark.parametrize("block", ["year", "month", "day", "hour"])
def test_rates_against_brute_force(spark, block):
    from decimal import Decimal
    rnd = random.Random(block)
    rates = [(rnd.choice(["a", "b", "c"]), moment(rnd), moment(rnd), Decimal(rnd.randrange(-5000, 9000)) / 1000) for _ in range(120)]
    rates += [("a", BASE, dt.datetime(9999, 12, 31), Decimal("1.001")), ("b", dt.datetime(1900, 1, 1), BASE, Decimal(7)), (None, BASE, dt.datetime(9999, 1, 1), Decimal(9)),
              ("a", None, dt.datetime(9999, 1, 1), Decimal(9)), ("a", BASE, None, Decimal(9)), ("a", BASE, dt.datetime(9999, 1, 1), None)]
    reads = [(rnd.choice(["a", "b", "c", "d"]), moment(rnd), i) for i in range(200)] + [("a", BASE, 900), ("a", BASE, 901), (None, BASE, 902), ("a", None, 903),
             ("a", dt.datetime(9999, 12, 31), 904), ("a", dt.datetime(9999, 12, 31, 1), 905), ("b", dt.datetime(1900, 1, 1), 906), ("b", dt.datetime(1899, 12, 31, 23), 907)]
    got = I.interval_rate(spark.createDataFrame(reads, READS).repartition(5), spark.createDataFrame(rates, RATES), "k", F.col("t"), "a", "b", "r", block=block)
    want = {n: sum((r for kk, a, b, r in rates if k is not None and kk == k and t is not None and a and b and r is not None and a <= t <= b), Decimal(0)) for k, t, n in reads}
    assert {r["n"]: r["rate"] for r in got.collect()} == want
    assert got.columns == ["k", "t", "n", "rate"] and got.schema["rate"].dataType.typeName() == "decimal"


def test_rates_without_any(spark):
    reads = spark.createDataFrame([("a", BASE, 1)], READS)
    none = spark.createDataFrame([], RATES)
    assert [r["rate"] for r in I.interval_rate(reads, none, "k", F.col("t"), "a", "b", "r").collect()] == [0]
    assert I.interval_rate(reads.limit(0), none, "k", F.col("t"), "a", "b", "r").collect() == []


def test_a_hot_key_is_split(spark):
    """The windows are partitioned by key and block of time, so one key is many groups."""
    reads = spark.range(1000).select(F.lit("a").alias("k"), (F.lit(BASE).cast("timestamp_ntz") + F.make_dt_interval(days=F.col("id") % 700)).alias("t"))
    rates = spark.createDataFrame([("a", BASE, BASE + dt.timedelta(days=18000), 1)], "k string, a timestamp_ntz, b timestamp_ntz, r int")
    df = I.interval_rate(reads, rates, "k", F.col("t"), "a", "b", "r")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Exchange hashpartitioning\(k#\d+, _block#\d+", plan) and "sequence" not in plan
    assert {r["rate"] for r in df.collect()} == {1}


# -- digests ------------------------------------------------------------------

KINDS = "k long, t string, d double, n int"


def versions(spark, seed, n=3000):
    rnd = random.Random(seed)
    rows = [(rnd.choice([None, i, i // 3]), rnd.choice(["x", "", None, "é"]), rnd.choice([0.0, 1.5, None, float("nan")]), rnd.choice([None, 1, 2])) for i in range(n)]
    other = [r for r in rows if rnd.random() > 0.01] + [(5, "new", 1.0, 1)] + [rows[7]] * 3
    other = [(k, t, d, 3 if rnd.random() < 0.01 else m) for k, t, d, m in other]
    return spark.createDataFrame(rows, KINDS).repartition(3), spark.createDataFrame(other, KINDS).repartition(5)


@pytest.mark.parametrize("strict", [False, True])
def test_digest_diff_equals_symmetric_diff(spark, strict):
    for seed in (1, 2):
        a, b = versions(spark, seed)
        got = sorted(map(str, D.digest_diff(a, b, ["k"], strict=strict).collect()))
        assert got == sorted(map(str, R.symmetric_diff(a, b, strict=strict).collect())) and got


def test_digest_diff_of_equal_tables(spark):
    a, _ = versions(spark, 3)
    assert D.digest_diff(a, a.repartition(7), ["k"], strict=True).collect() == []
    assert D.digest_diff(a.limit(0), a.limit(0), ["k"]).collect() == []
    zero = spark.createDataFrame([(1, "x", 0.0, 1), (2, "x", float("nan"), 1)], KINDS)
    minus = zero.withColumn("d", F.when(F.col("d") == 0, F.lit(-0.0)).otherwise(F.col("d")))
    assert [df.count() for df in D.differing_rows(zero, minus, ["k"], zero.columns)] == [0, 0]


def test_repeats_and_moved_nulls_are_seen(spark):
    """Two copies more cancel in the xor, a NULL that changes its column in a plain hash."""
    a = spark.createDataFrame([(1, "x", 1.0, 1), (2, None, None, 7), (3, "a", None, None)], KINDS)
    b = spark.createDataFrame([(1, "x", 1.0, 1)] * 3 + [(2, None, 7.0, None), (3, "a", None, None)], KINDS)
    got = D.digest_diff(a, b, ["k"], strict=True).groupBy("k", "side").count().collect()
    assert sorted(map(tuple, got)) == [(1, "only_in_b", 2), (2, "only_in_a", 1), (2, "only_in_b", 1)]


def test_rows_of_equal_ranges_are_not_shuffled(spark):
    a = spark.range(20_000).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    b = a.withColumn("v", F.when(F.col("k").isin(17, 4711), F.lit("changed")).otherwise(F.col("v"))).where("k <> 99")
    left, right = D.differing_rows(a, b, ["k"], ["k", "v"])
    assert 3 <= left.count() <= 8 and 2 <= right.count() <= 7
    diff = D.digest_diff(a, b, ["k"])
    assert {(r["k"], r["side"]) for r in diff.collect()} == {(17, "only_in_a"), (17, "only_in_b"), (4711, "only_in_a"), (4711, "only_in_b"), (99, "only_in_a")}
    # what feeds the exchange of the comparison comes through broadcast joins with the digests
    plan = diff._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and plan.count("BroadcastHashJoin") >= 2


# -- sweep --------------------------------------------------------------------

@pytest.mark.parametrize("scoped", [False, True])
def test_range_sweep_equals_orphan_sweep(spark, scoped):
    rnd = random.Random(9)
    rows = [(i, rnd.choice(["a", "b", None]), i % 3, "v") for i in range(4000)] + [(None, "a", 0, "null key"), (7, "a", None, "null scope")]
    target = spark.createDataFrame(rows, "k int, t string, s int, v string").repartition(4)
    universe = spark.createDataFrame([r[:2] for r in rows if rnd.random() > 0.01] + [(9999, "new"), (None, "a")] * 2, "k long, t string").repartition(3)
    scope = (F.col("s") == 1) if scoped else None
    want = M.orphan_sweep(target, universe, ["k", "t"], scope=scope)
    got = D.range_sweep(target, universe, ["k", "t"], scope=scope)
    for g, w in zip(got, want):
        assert g.columns == target.columns and sorted(map(str, g.collect())) == sorted(map(str, w.collect()))


def test_range_sweep_shuffles_suspects_only(spark):
    target = spark.range(30_000).select(F.col("id").alias("k"), F.lit("payload").alias("v"))
    kept, removed = D.range_sweep(target, target.where("k % 10000 <> 3").select("k"), ["k"])
    assert sorted(r["k"] for r in removed.collect()) == [3, 10003, 20003] and kept.count() == 29_997
    # the payload is in the exchange of the suspects only, which is below the filter on the mark
    text = removed._jdf.queryExecution().optimizedPlan().toString()
    assert "_differs" in text or "_bits" in text
    placed, source = D._placed(target, ["k"], ["k"]), D._placed(target.where("k % 10000 <> 3").select("k"), ["k"], ["k"])
    assert 3 <= D.marked(placed, D.differing_ranges(placed, source)).where("_differs").count() <= 12


def test_range_sweep_refuses_an_empty_universe(spark):
    target = spark.range(3).withColumnRenamed("id", "k")
    none = target.limit(0)
    with pytest.raises(M.MergeError):
        D.range_sweep(target, none, ["k"])
    kept, removed = D.range_sweep(target, none, ["k"], allow_empty_universe=True)
    assert kept.count() == 0 and removed.count() == 3
