"""Regression frames for the source dialect's traps (T1-T15) and the blocks."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tierwise.functions import exprs as X
from tierwise.operators import blocks as B
from tierwise.operators import intervals as I

D = dt.date
TS = dt.datetime


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()] if cols else [tuple(r) for r in df.collect()]


def test_blank_text_is_null_and_concat_ignores_null(spark):
    df = spark.createDataFrame([(None,), ("",), (" ",), ("  ",), (" ab ",)], "c string")
    got = rows(df.select(X.blank_to_null("c").alias("x"), X.oconcat(F.lit("k"), "c").alias("y")))
    assert [g[0] for g in got] == [None, None, None, None, "ab"]       # T1, T3
    assert got[0][1] == "k"                                           # T2: a || NULL = a


def test_full_address_faithful_never_appends_complement(spark):
    df = spark.createDataFrame([("Rua A", "10", "apto 2"), ("Rua B", None, None)], "s string, n string, c string")
    faithful = [r[0] for r in df.select(X.full_address("s", "n", "c")).collect()]
    fixed = [r[0] for r in df.select(X.full_address("s", "n", "c", faithful=False)).collect()]
    assert faithful == ["Rua A, 10", "Rua B, "]
    assert fixed == ["Rua A, 10 (apto 2)", "Rua B, "]


def test_null_ordering_helpers(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    assert [r[0] for r in df.orderBy(X.asc("v")).collect()] == [1, 3, None]       # T4
    assert [r[0] for r in df.orderBy(X.desc("v")).collect()] == [None, 3, 1]


def test_lpad_truncates_and_fm00(spark):
    df = spark.createDataFrame([(123456789012,), (7,), (123,)], "n long")
    got = rows(df.select(X.lpad_num("n", 11), X.fm00("n")))
    assert got[0][0] == "12345678901"                                  # T9
    assert got[1] == ("00000000007", "07") and got[2][1] == "###"


def test_safe_div_and_try_number(spark):
    df = spark.createDataFrame([(10.0, 0), (10.0, 4)], "a double, b int")
    assert [r[0] for r in df.select(X.safe_div("a", "b")).collect()] == [None, 2.5]   # T10
    t = spark.createDataFrame([("12,5",), ("x",), (None,)], "c string")
    assert [r[0] for r in t.select(X.locale_decimal("c")).collect()] == [12.5, None, None]  # T12


def test_int_text(spark):
    df = spark.createDataFrame([("14.0",), ("0",), (None,), (" DTV-100 ",), ("3.7",)], "c string")
    assert [r[0] for r in df.select(X.int_text("c")).collect()] == ["14", "0", "", "DTV-100", "3"]


def test_month_key_has_no_zero_padding(spark):
    df = spark.createDataFrame([(D(2023, 1, 1),)], "d date")
    assert df.select(X.month_key("d")).first()[0] == "1|2023"                          # T14


def test_quarter_label_null_goes_to_else(spark):
    df = spark.createDataFrame([(D(2023, 2, 1),), (D(2023, 8, 1),), (None,)], "d date")
    assert [r[0] for r in df.select(X.quarter_label("d")).collect()] == ["Q1", "Q3", "Q4"]


def test_full_days_floors_like_timedelta_days(spark):
    df = spark.createDataFrame([(TS(2024, 1, 2, 1), TS(2024, 1, 1, 23)), (TS(2024, 1, 1, 23), TS(2024, 1, 2, 1)),
                                (TS(2024, 1, 1, 1), TS(2024, 1, 2, 23))], "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(X.full_days("a", "b")).collect()] == [0, -1, -2]


def test_sla_and_delivery_buckets(spark):
    as_of = "2024-01-31 00:00:00"
    df = spark.createDataFrame([
        (TS(2024, 1, 1), None, None, None),
        (TS(2024, 1, 25), None, TS(2024, 1, 25), "RETIRA"),
        (TS(2024, 1, 1), TS(2024, 1, 11), TS(2024, 1, 12), "CORREIO / SEDEX"),
        (TS(2024, 1, 1), TS(2024, 1, 12), TS(2023, 12, 1), "X"),
        (TS(2024, 1, 1), TS(1900, 12, 31), TS(2024, 2, 15), "X"),
    ], "e timestamp_ntz, f timestamp_ntz, dlv timestamp_ntz, carrier string")
    got = rows(df.select(X.sla_status("e", "f", as_of), X.delivery_bucket("dlv", "e"),
                         X.finish_year_text("f"), X.transport_type("carrier")))
    assert got[0] == ("Em Aberto Atrasado", "Sem Data", "Sem Data", "Sem NFSaída")
    assert got[1] == ("Em Aberto no Prazo", "Sem Data", "Sem Data", "Retirada")   # 0 days -> Sem Data
    assert got[2] == ("Finalizado no Prazo", "Entre 11 e 20 Dias", "2024", "Correios")  # 10 days on time
    assert got[3] == ("Finalizado em Atraso", "Sem Data", "2024", "Transportadoras")    # 11 days late
    assert got[4][1] == "Maior que 30 Dias" and got[4][2] == "Sem Data"


def test_repeat_class(spark):
    df = spark.createDataFrame([
        ("A", D(2024, 7, 1), D(2024, 1, 3)),     # 180 days -> 1
        ("A", D(2024, 7, 1), D(2024, 1, 2)),     # 181 days -> 0
        ("S/N", D(2024, 7, 1), D(2024, 6, 30)),  # invalid -> 2
        (None, D(2024, 7, 1), None),
        ("B", D(2024, 7, 1), None),
    ], "s string, d date, p date")
    assert [r[0] for r in df.select(X.repeat_class("s", "d", "p")).collect()] == [1, 0, 2, 2, 0]


def test_macro_region_and_pipe_key(spark):
    df = spark.createDataFrame([("SP", "a", 1), ("XX", None, 2)], "uf string, a string, b int")
    got = rows(df.select(X.macro_region("uf"), X.pipe_key("b", "a")))
    assert got == [("Sudeste", "1|a"), (None, None)]


# ---------------------------------------------------------------------------
# blocks
# ---------------------------------------------------------------------------
def test_nth_event_uses_days(spark):
    df = spark.createDataFrame([
        (1, TS(2024, 1, 1, 9)), (1, TS(2024, 1, 1, 15)), (1, TS(2024, 1, 3)), (1, TS(2024, 1, 9)),
        (1, TS(2024, 1, 20)), (1, TS(2024, 2, 1)), (2, TS(2024, 5, 5))], "g long, t timestamp_ntz")
    r = {x["g"]: x for x in B.nth_event(df, "g", "t", 4).collect()}
    assert (r[1]["day_1"], r[1]["day_2"], r[1]["day_4"], r[1]["last_day"], r[1]["n_days"]) == \
        (D(2024, 1, 1), D(2024, 1, 3), D(2024, 1, 20), D(2024, 2, 1), 5)
    assert r[2]["day_2"] is None


def test_first_last_by_ties(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1), 5, 30), (1, D(2024, 1, 1), 5, 10), (1, D(2024, 2, 1), 1, 7),
                                (1, None, 9, 99)], "g int, d date, k int, rep int")
    r = B.first_last_by(df, "g", ["d", "k"], "rep").first()
    assert (r["first_value"], r["last_value"]) == (10, 7)


def test_trailing_months_gap_aware_and_cutoff_after_window(spark):
    df = spark.createDataFrame([
        ("p", D(2023, 1, 1), Decimal("5")), ("p", D(2023, 6, 1), Decimal("7")),
        ("p", D(2023, 7, 1), Decimal("1")), ("p", D(2023, 9, 1), Decimal("2"))], "k string, m date, q decimal(18,2)")
    r = {x["m"]: x["t"] for x in B.trailing_months(df, "k", "m", "q", out="t", cutoff="2023-07-01").collect()}
    assert set(r) == {D(2023, 7, 1), D(2023, 9, 1)}                   # cutoff after the window
    assert r[D(2023, 7, 1)] == Decimal("12")                          # Jan..Jun = 5 + 7
    assert r[D(2023, 9, 1)] == Decimal("8")                           # Mar..Aug = 7 + 1


def test_trailing_first_month_is_null(spark):
    df = spark.createDataFrame([("p", D(2023, 1, 1), Decimal("5"))], "k string, m date, q decimal(18,2)")
    assert B.trailing_months(df, "k", "m", "q", out="t").first()["t"] is None


def test_previous_event_excludes_blank_serials(spark):
    df = spark.createDataFrame([("A", TS(2024, 1, 1)), ("A", TS(2024, 1, 1, 5)), ("A", TS(2024, 3, 1)),
                                (" ", TS(2024, 1, 1)), (None, TS(2024, 1, 1))], "s string, t timestamp_ntz")
    got = sorted(rows(B.previous_event(df, "s", "t"), "s", "day", "prev_day"))
    assert got == [("A", D(2024, 1, 1), None), ("A", D(2024, 3, 1), D(2024, 1, 1))]


def test_interval_rate_overlaps_boundaries_and_no_match(spark):
    rates = spark.createDataFrame([("c", D(2024, 1, 1), D(2024, 1, 31), 2), ("c", D(2024, 1, 31), D(2024, 2, 10), 3)],
                                  "k string, a date, b date, r int")
    reads = spark.createDataFrame([("c", D(2024, 1, 1)), ("c", D(2024, 1, 31)), ("c", D(2024, 2, 11)),
                                   ("x", D(2024, 1, 5))], "k string, d date")
    got = sorted((r["k"], r["d"], float(r["rate"])) for r in I.interval_rate(reads, rates, "k", F.col("d"), "a", "b", "r").collect())
    assert got == [("c", D(2024, 1, 1), 2.0), ("c", D(2024, 1, 31), 5.0), ("c", D(2024, 2, 11), 0.0),
                   ("x", D(2024, 1, 5), 0.0)]                          # T11: no match -> 0


def test_allocate_share_counts_all_lines_before_filter(spark):
    lines = spark.createDataFrame([(1, "a", 90.0), (1, "b", 90.0), (1, "b", 90.0), (2, "a", 0.0)],
                                  "note int, kind string, fee double")
    counts = B.line_counts(lines, "note")
    got = sorted(rows(B.allocate_share(lines, counts, "note", F.col("fee")).where("kind = 'a'"), "note", "share"))
    assert got == [(1, 30.0), (2, 0.0)]


def test_lookup_exact_or_latest(spark):
    facts = spark.createDataFrame([(1, D(2024, 1, 2)), (1, D(2024, 1, 9)), (2, D(2024, 1, 1))], "k int, d date")
    look = spark.createDataFrame([(1, D(2024, 1, 2), 5), (1, D(2024, 1, 5), 8)], "k int, d date, v int")
    got = sorted(rows(B.lookup_exact_or_latest(facts, look, "k", F.col("d"), look.d, look.v, "x"), "k", "d", "x"))
    assert got == [(1, D(2024, 1, 2), 5), (1, D(2024, 1, 9), 8), (2, D(2024, 1, 1), None)]


def test_union_blocks_typed_padding(spark):
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    b = spark.createDataFrame([(2.5,)], "v double")
    u = B.union_blocks([a, b], [("id", "bigint"), ("s", "string"), ("v", "double")])
    assert u.dtypes == [("id", "bigint"), ("s", "string"), ("v", "double")]
    assert sorted(rows(u), key=str) == sorted([(1, "x", None), (None, None, 2.5)], key=str)


def test_scaled_sum_units(spark):
    df = spark.createDataFrame([("a", "D", 1.0, 2.0), ("b", "S", 120.0, 1.0), ("c", "?", 3.0, 1.0)],
                               "g string, u string, v double, o double")
    got = {r["g"]: (r["minutes"], r["product"]) for r in B.scaled_sum(df, "g", "v", "u", "o").collect()}
    assert got == {"a": (1440.0, 2880.0), "b": (2.0, 2.0), "c": (3.0, 3.0)}


def test_trim_of_blank_sentinel_is_null(spark):
    df = spark.createDataFrame([(" ",), (" ab ",)], "c string")
    assert [tuple(r) for r in df.select(X.trim_upper("c"), X.trim_lower("c")).collect()] == \
        [(None, None), ("AB", "ab")]                                     # T3: TRIM(' ') IS NULL


def test_full_days_ignores_session_time_zone(spark):
    """1995-10-15 00:00 does not exist in Sao Paulo (DST began at midnight);
    the day difference must not depend on the session time zone."""
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        df = spark.createDataFrame([(TS(1995, 10, 16), TS(1995, 10, 15)), (TS(1995, 10, 15), TS(1995, 10, 14, 23))],
                                   "a timestamp_ntz, b timestamp_ntz")
        assert [r[0] for r in df.select(X.full_days("a", "b")).collect()] == [1, 0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
