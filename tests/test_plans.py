"""Physical-plan shape of the skew-sensitive operators (one key may hold a third
of all rows): first-row picks combine map-side, windows run on pre-aggregated
groups, scans receive the pushed predicates."""

import datetime as dt

from pyspark.sql import functions as F

from tierwise.operators import blocks as B
from tierwise.operators import merge as M
from tierwise.operators import reconcile as R
from tierwise.plans.driver import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def hot_frame(spark, n=3000):
    # key 0 holds a third of the rows
    rows = [(0 if i % 3 == 0 else i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), i % 7) for i in range(n)]
    return spark.createDataFrame(rows, "k long, t timestamp_ntz, v int")


def test_first_row_picks_are_partial_aggregates(spark):
    df = hot_frame(spark)
    for p in (plan(M.dedup_first(df, ["k"], ["t"])), plan(B.first_last_by(df, "k", ["t"], "v"))):
        assert "partial_min" in p and "Window" not in p
    assert "partial_sum" in plan(R.symmetric_diff(df, df.limit(10)))


def test_windows_run_on_preaggregated_groups(spark):
    df = hot_frame(spark)
    p = plan(B.nth_event(df, "k", "t", 2))
    assert p.index("Window") < p.rindex("HashAggregate")        # the window sits above the distinct
    m = B.monthly_sum(df, "k", "t", "v")
    p2 = plan(B.trailing_months(m, "k", "month_start", "qty"))
    assert p2.index("Window") < p2.rindex("partial_sum")


def test_hot_key_result_is_exact(spark):
    df = hot_frame(spark)
    got = {r.k: r.t for r in M.dedup_first(df, ["k"], ["t"]).collect()}
    assert got[0] == dt.datetime(2024, 1, 1) and len(got) == df.select("k").distinct().count()


def test_scan_receives_lookback_predicate(spark, sf_small):
    p = plan(QUERIES["scoped_lookback"](spark, sf_small))
    assert "GreaterThanOrEqual(o_orderdate" in p and "In(o_orderstatus" in p
    p = plan(QUERIES["trailing_months"](spark, sf_small))
    assert "GreaterThanOrEqual(l_shipdate" in p
