"""Property tests: operators against brute force on random small frames."""

import datetime as dt
from collections import Counter
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierwise.operators import blocks as B
from tierwise.operators import intervals as I
from tierwise.operators import merge as M
from tierwise.operators import reconcile as R

SETTINGS = settings(max_examples=10, deadline=None, derandomize=True, database=None,
                    suppress_health_check=list(HealthCheck))
small = st.one_of(st.none(), st.integers(0, 3))
rows = st.lists(st.tuples(st.integers(0, 4), small, small), min_size=0, max_size=25)


def _key_nulls_last(v):
    return (v is None, v if v is not None else 0)


def _key_nulls_first(v):
    return (v is not None, v if v is not None else 0)


@SETTINGS
@given(rows)
def test_dedup_first_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, "k int, o int, v int")
    got = sorted(tuple(r) for r in M.dedup_first(df, ["k"], ["o"]).collect())
    best = {}
    for k, o, v in data:
        cand = (_key_nulls_last(o), _key_nulls_first(v))
        if k not in best or cand < best[k][0]:
            best[k] = (cand, (k, o, v))
    assert got == sorted(x[1] for x in best.values())


@SETTINGS
@given(rows, rows)
def test_symmetric_diff_matches_multisets(spark, a, b):
    da = spark.createDataFrame(a, "k int, o int, v int")
    db = spark.createDataFrame(b, "k int, o int, v int")
    ca, cb = Counter(a), Counter(b)
    distinct = sorted([(*r, "only_in_a") for r in set(ca) - set(cb)] + [(*r, "only_in_b") for r in set(cb) - set(ca)],
                      key=str)
    strict = sorted([(*r, "only_in_a") for r in (ca - cb).elements()] + [(*r, "only_in_b") for r in (cb - ca).elements()],
                    key=str)
    assert sorted((tuple(r) for r in R.symmetric_diff(da, db).collect()), key=str) == distinct
    assert sorted((tuple(r) for r in R.symmetric_diff(da, db, strict=True).collect()), key=str) == strict


months = st.lists(st.tuples(st.sampled_from(["p", "q"]), st.integers(0, 23), st.integers(1, 9)),
                  min_size=1, max_size=20)


@SETTINGS
@given(months)
def test_trailing_months_matches_brute_force(spark, data):
    mk = lambda i: dt.date(2020 + i // 12, i % 12 + 1, 1)
    agg = Counter()
    for key, i, q in data:
        agg[(key, i)] += q
    df = spark.createDataFrame([(k, mk(i), Decimal(q)) for (k, i), q in agg.items()],
                               "k string, m date, q decimal(18,2)")
    got = {(r.k, r.m): r.t for r in B.trailing_months(df, "k", "m", "q", back=6, skip=1, out="t").collect()}
    for (k, i), _ in agg.items():
        window = [agg[(k, j)] for j in range(i - 6, i) if (k, j) in agg]
        assert got[(k, mk(i))] == (Decimal(sum(window)) if window else None)


intervals = st.lists(st.tuples(st.sampled_from(["c", "d"]), st.integers(0, 20), st.integers(0, 10),
                               st.integers(1, 5)), max_size=6)
readings = st.lists(st.tuples(st.sampled_from(["c", "d", "e"]), st.integers(0, 30)), min_size=1, max_size=10)


@SETTINGS
@given(intervals, readings)
def test_interval_rate_matches_brute_force(spark, ivs, reads):
    base = dt.date(2024, 1, 1)
    day = lambda i: base + dt.timedelta(days=i)
    rates = spark.createDataFrame([(k, day(s), day(s + n), r) for k, s, n, r in ivs] or [("z", base, base, 0)],
                                  "k string, a date, b date, r int")
    rd = spark.createDataFrame([(k, day(i)) for k, i in reads], "k string, d date")
    got = sorted((r.k, r.d, float(r.rate)) for r in I.interval_rate(rd, rates, "k", F.col("d"), "a", "b", "r").collect())
    want = sorted((k, day(i), float(sum(r for kk, s, n, r in ivs if kk == k and s <= i <= s + n))) for k, i in reads)
    assert got == want


events = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 15), st.integers(0, 23),
                            st.one_of(st.none(), st.integers(0, 5))),
                  min_size=1, max_size=25)


@SETTINGS
@given(events)
def test_nth_event_and_first_last_match_brute_force(spark, data):
    ts = lambda d, h: dt.datetime(2024, 1, 1) + dt.timedelta(days=d, hours=h)
    df = spark.createDataFrame([(g, ts(d, h), h, v) for g, d, h, v in data], "g int, t timestamp_ntz, o int, v int")
    nth = {r.g: r for r in B.nth_event(df, "g", "t", 3).collect()}
    fl = {r.g: (r.first_value, r.last_value) for r in B.first_last_by(df, "g", ["t", "o"], "v").collect()}
    for g in {x[0] for x in data}:
        days = sorted({ts(d, 0).date() for gg, d, h, v in data if gg == g})
        want = days[:3] + [None] * (3 - len(days[:3]))
        r = nth[g]
        assert [r.day_1, r.day_2, r.day_3, r.last_day, r.n_days] == [*want, days[-1], len(days)]
        rows_g = [(ts(d, h), h, v) for gg, d, h, v in data if gg == g]
        lo, hi = min(x[:2] for x in rows_g), max(x[:2] for x in rows_g)
        first_vals = [v for t, o, v in rows_g if (t, o) == lo and v is not None]
        last_vals = [v for t, o, v in rows_g if (t, o) == hi and v is not None]
        assert fl[g] == (min(first_vals) if first_vals else None, max(last_vals) if last_vals else None)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 6)), min_size=1, max_size=10),
       st.lists(st.tuples(st.integers(0, 2), st.integers(0, 6), st.integers(0, 9)), max_size=12))
def test_lookup_exact_or_latest_matches_brute_force(spark, facts, looks):
    day = lambda i: dt.date(2024, 1, 1) + dt.timedelta(days=i)
    f = spark.createDataFrame([(k, day(i)) for k, i in facts], "k int, d date")
    lk = spark.createDataFrame([(k, day(i), v) for k, i, v in looks] or [(99, day(0), 0)], "k int, d date, v int")
    got = sorted(tuple(r) for r in B.lookup_exact_or_latest(f, lk, "k", F.col("d"), lk.d, lk.v, "x").collect())
    want = []
    for k, i in facts:
        same = [v for kk, j, v in looks if kk == k and j == i]
        anyd = [v for kk, j, v in looks if kk == k]
        want.append((k, day(i), max(same) if same else (max(anyd) if anyd else None)))
    assert got == sorted(want, key=lambda t: (t[0], t[1], -1 if t[2] is None else t[2]))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["A", "B", " ", None]), st.integers(0, 20), st.integers(0, 23)),
                min_size=1, max_size=25))
def test_previous_event_matches_brute_force(spark, data):
    ts = lambda d, h: dt.datetime(2024, 1, 1) + dt.timedelta(days=d, hours=h)
    df = spark.createDataFrame([(k, ts(d, h)) for k, d, h in data], "k string, t timestamp_ntz")
    got = sorted(tuple(r) for r in B.previous_event(df, "k", "t").collect())
    want = []
    for k in {k for k, _, _ in data if k is not None and k.strip() != ""}:
        days = sorted({ts(d, 0).date() for kk, d, _ in data if kk == k})
        want += [(k, day, days[i - 1] if i else None) for i, day in enumerate(days)]
    assert got == sorted(want, key=lambda t: (t[0], t[1]))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 4), st.booleans()), min_size=1, max_size=20),
       st.dictionaries(st.integers(0, 4), st.integers(0, 100)))
def test_allocate_share_matches_brute_force(spark, lines, fees):
    df = spark.createDataFrame([(n, keep, float(fees.get(n, 0))) for n, keep in lines],
                               "note int, keep boolean, fee double")
    counts = B.line_counts(df, "note")
    got = sorted((r.note, r.n_lines, r.share) for r in
                 B.allocate_share(df, counts, "note", F.col("fee")).where("keep").collect())
    n = Counter(note for note, _ in lines)                                   # all lines, before the filter
    want = sorted((note, n[note], fees.get(note, 0) / n[note]) for note, keep in lines if keep)
    assert got == want
