"""Trailing months kept up to date by changes, and balanced read ranges."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tierwise.operators import blocks as B
from tierwise.operators import rolling as RO
from tierwise.sources import ranges as RG

SCHEMA = "k string, d timestamp_ntz, v decimal(12,3), note string"


def row(rnd):
    day = dt.datetime(2023, 1, 1) + dt.timedelta(days=rnd.randrange(900), hours=rnd.randrange(24))
    return (rnd.choice(["a", "b", None]), day, rnd.choice([None, Decimal(rnd.randrange(-9000, 9000)) / 1000]), "n")


@pytest.mark.parametrize("seed,back,skip", [(1, 6, 1), (2, 3, 1), (3, 12, 2)])
def test_refreshed_equals_rebuilt(spark, seed, back, skip):
    rnd = random.Random(seed)
    rows = [row(rnd) for _ in range(150)] + [("lonely", dt.datetime(2023, 5, 5), Decimal("1.5"), "n")]
    out = [r for r in rows if rnd.random() < 0.1 or r[0] == "lonely"]
    kept = [r for r in rows if r not in out]
    into = [(k, d + dt.timedelta(days=rnd.choice([0, 35])), v, "changed") for k, d, v, _ in out if rnd.random() < 0.7 and k != "lonely"] + [row(rnd) for _ in range(5)]
    into += [("new", dt.datetime(2024, 1, 31), None, "n")]

    def df(data):
        return spark.createDataFrame(data, SCHEMA).repartition(3)

    state = RO.monthly_state(df(rows), "k", "d", "v")
    trailing = B.trailing_months(state.select("k", "month_start", "qty"), "k", "month_start", "qty", back, skip)
    change = RO.monthly_change(df(out), df(into), "k", "d", "v")
    state = RO.apply_change(state, change, "k")
    got = RO.refresh_trailing(trailing, state, change, "k", back=back, skip=skip)
    want = RO.monthly_state(df(kept + into), "k", "d", "v")
    assert sorted(map(str, state.collect())) == sorted(map(str, want.collect()))
    whole = B.trailing_months(want.select("k", "month_start", "qty"), "k", "month_start", "qty", back, skip)
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))


def test_a_change_of_other_columns_changes_no_month(spark):
    rows = [("a", dt.datetime(2024, 1, 5), Decimal(1), "x"), ("a", dt.datetime(2024, 2, 5), None, "x")]
    change = RO.monthly_change(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(*r[:3], "y") for r in rows], SCHEMA), "k", "d", "v")
    assert change.collect() == []


def test_windows_in_reach(spark):
    change = spark.createDataFrame([("a", dt.date(2024, 1, 1))], "k string, month_start date")
    got = sorted(r["month_start"].month for r in RO.windows_in_reach(change, "k", back=3, skip=2).collect())
    assert got == [1, 3, 4]


def covered(df, predicates):
    """Rows of each range; every row must be in exactly one."""
    tests = [F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates]
    got = df.agg(*[F.sum(t) for t in tests], F.max(sum(tests, F.lit(0))), F.min(sum(tests, F.lit(0))), F.count(F.lit(1))).first()
    assert got[-3] == got[-2] == 1 and sum(got[:-3]) == got[-1]
    return list(got[:-3])


def test_ranges_of_skewed_keys(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 4 == 0, F.lit(7)).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.col("id") * F.col("id")).alias("k"))
    n = covered(df, RG.balanced_predicates(df, "k", 8))
    assert len(n) <= 10 and 10_000 in n                    # a key with a quarter of the rows is a range of its own
    assert sorted(n)[-2] <= 2 * 40_000 / 8 + 4_000          # and the nulls are in the first
    assert covered(df, RG.balanced_predicates(df, "k", 1)) == [40_000]
    one = df.where("k = 7")
    assert covered(one, RG.balanced_predicates(one, "k", 5)) == [0, 10_000, 0]
    assert RG.balanced_predicates(df.limit(0), "k", 5) == ["1 = 1"]


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz", "decimal(10,2)", "double", "int"])
def test_ranges_of_other_keys(spark, kind):
    base = spark.range(3000)
    k = {"date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")), "timestamp_ntz": F.lit("2020-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)")),
         "decimal(10,2)": (F.col("id") / 4).cast("decimal(10,2)"), "double": F.col("id") / 7, "int": -F.col("id").cast("int")}[kind]
    n = covered(base.select(k.alias("k")), RG.balanced_predicates(base.select(k.alias("k")), "k", 6))
    assert len(n) == 6 and max(n) - min(n) <= 2
    with pytest.raises(TypeError):
        RG.balanced_predicates(base.select(F.lit("x").alias("k")), "k", 2)
