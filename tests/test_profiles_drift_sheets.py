"""Profiles that add up, drift of types, joins with heavy keys, sheets with rejects."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwise.operators import heavy_keys as HK
from tierwise.operators.ingest import ingest
from tierwise.session import scratch_path
from tierwise.sources import drift as DR
from tierwise.sources import profiles as P
from tierwise.sources import sheets
from tierwise.sources.catalog import TableSpec
from tierwise.sources.schema import SchemaDriftError
from tierwise.sources.store import VersionedTable


# profiles -------------------------------------------------------------------------
def test_merged_profiles_equal_the_profile_of_the_whole(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice(["a", "bb", "", "  ", "0012", None]), rnd.choice([None, rnd.random() * 100]), [i]) for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, t string, x double, arr array<long>").repartition(3)
    parts = P.part_profiles(df, "t", F.col("id") % 7)
    assert parts.where("part = '0'").count() == 3                      # the array has no profile
    one, many = P.report(P.merge_profiles(P.part_profiles(df, "t", F.lit("all")))), P.report(P.merge_profiles(parts))
    twice = P.report(P.merge_profiles(P.merge_profiles(parts.where("part < '4'")).unionByName(P.merge_profiles(parts.where("part >= '4'")))))
    exact = [c for c in one.columns if c != "distinct_estimate" and not c.startswith("q")]
    assert sorted(map(str, one.select(exact).collect())) == sorted(map(str, many.select(exact).collect())) == sorted(map(str, twice.select(exact).collect()))
    got = {r["column_name"]: r for r in twice.collect()}
    assert abs(got["id"]["distinct_estimate"] - 4000) < 4000 * 0.08 and got["t"]["distinct_estimate"] == 5
    assert abs(got["id"]["q50"] - 2000) < 200 and got["t"]["q50"] is None
    assert got["t"]["n_digits"] == sum(r[1] == "0012" for r in rows) and got["t"]["n_blank"] == sum(r[1] in ("", "  ") for r in rows)


def test_profile_of_nothing_and_of_nulls(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert P.report(P.merge_profiles(P.part_profiles(empty, "t", F.lit(1)))).collect() == []
    nulls = spark.createDataFrame([(None, None)] * 3, "a int, b string")
    got = {r["column_name"]: r for r in P.report(P.merge_profiles(P.part_profiles(nulls, "t", F.lit(1)))).collect()}
    assert got["a"]["q50"] is None and got["a"]["n_nulls"] == 3 and got["b"]["sink_type"] == "VARCHAR(100)" and got["b"]["distinct_estimate"] == 0


# drift ----------------------------------------------------------------------------
@pytest.mark.parametrize("a,b,want", [
    ("tinyint", "int", "int"), ("int", "bigint", "bigint"), ("bigint", "decimal(10,2)", "decimal(21,2)"), ("decimal(10,2)", "decimal(6,4)", "decimal(12,4)"),
    ("decimal(38,0)", "decimal(38,10)", None), ("int", "double", "double"), ("bigint", "double", None), ("float", "double", "double"),
    ("int", "float", "double"), ("smallint", "float", "float"), ("decimal(5,1)", "double", None), ("date", "timestamp_ntz", "timestamp_ntz"),
    ("date", "timestamp", None), ("string", "int", None), ("string", "string", "string"), ("boolean", "int", None)])
def test_common_type(spark, a, b, want):
    def kind(t):
        return T.StructType.fromDDL(f"c {t}")["c"].dataType
    for x, y in ((a, b), (b, a)):
        got = DR.common_type(kind(x), kind(y))
        assert (got and got.simpleString()) == want


SPEC = TableSpec(name="t", keys=("k",), audit_col="d")


def _rows(spark, data, kind):
    return spark.createDataFrame(data, f"k int, v {kind}, d timestamp_ntz")


def day(n):
    import datetime as dt
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


@pytest.mark.parametrize("part", [None, "d"])
def test_widened_type_through_the_merge(spark, part):
    t = VersionedTable(spark, scratch_path(spark, "drift"), partition_col=part)
    ingest(SPEC, _rows(spark, [(1, 5, day(0)), (2, 6, day(40)), (3, 7, day(80))], "int"), t, day(81))
    new = _rows(spark, [(2, 1 << 40, day(80)), (4, 8, day(80))], "bigint")
    with pytest.raises(SchemaDriftError):
        ingest(TableSpec(name="t", keys=("k",), audit_col="d"), new.select(F.col("k"), F.col("v").cast("string").alias("v"), "d"), t, day(81), drift="widen")
    got = ingest(SPEC, new, t, day(81), drift="widen")
    assert (got.inserted, got.updated, got.saved) == (1, 1, 4)
    assert t.read().schema["v"].dataType == T.LongType()
    assert sorted((r["k"], r["v"]) for r in t.read().collect()) == [(1, 5), (2, 1 << 40), (3, 7), (4, 8)]
    # a batch of the smaller type afterwards narrows nothing
    ingest(SPEC, _rows(spark, [(5, 9, day(80))], "int"), t, day(81), drift="widen")
    assert t.read().schema["v"].dataType == T.LongType() and t.read().count() == 5


def test_lossless_takes_text_that_is_a_number_and_refuses_the_rest(spark):
    t = VersionedTable(spark, scratch_path(spark, "drift"))
    ingest(SPEC, _rows(spark, [(1, 5, day(0))], "int"), t, day(1))
    with pytest.raises(SchemaDriftError, match="2 values change"):
        ingest(SPEC, _rows(spark, [(2, "007", day(0)), (3, "x", day(0)), (4, "8", day(0)), (5, None, day(0))], "string"), t, day(1), drift="lossless")
    assert t.read().count() == 1                                        # refused before anything was written
    ingest(SPEC, _rows(spark, [(4, "8", day(0)), (5, None, day(0))], "string"), t, day(1), drift="lossless")
    assert sorted((r["k"], r["v"]) for r in t.read().collect()) == [(1, 5), (4, 8), (5, None)]


@pytest.mark.parametrize("new,old,value,lost", [
    ("double", "decimal(10,2)", 0.1, False), ("double", "decimal(10,2)", 0.123, True), ("double", "decimal(4,2)", 1e6, True), ("double", "bigint", float("nan"), True),
    ("double", "int", 3.0, False), ("string", "int", " 7", True), ("decimal(12,4)", "decimal(10,2)", Decimal("1.2345"), True), ("boolean", "int", True, True)])
def test_lost_values(spark, new, old, value, lost):
    df = spark.createDataFrame([(value,), (None,)], f"c {new}")
    kind = T.StructType.fromDDL(f"c {old}")["c"].dataType
    assert [r[0] for r in df.select(DR.is_lost(F.col("c"), kind, df.schema["c"].dataType)).collect()] == [lost, False]


# heavy keys -----------------------------------------------------------------------
def test_heavy_join_equals_the_plain_join(spark):
    rnd = random.Random(5)
    left = [(i, "hot" if i % 3 == 0 else rnd.choice([None, " ", f"s{rnd.randrange(300)}"]), i % 5) for i in range(6000)] + [(1, "hot", 1)] * 400
    right = [("hot", 0, "x"), ("hot", 1, "y"), (None, 1, "z")] + [(f"s{i}", i % 5, f"n{i}") for i in range(0, 300, 2)] * 2
    a = spark.createDataFrame(left, "id int, serial string, emp int").repartition(5)
    b = spark.createDataFrame(right, "serial string, emp int, name string")
    for keys in (["serial"], ["serial", "emp"]):
        r = b if len(keys) == 2 else b.drop("emp")
        got = HK.heavy_left_join(a, r, keys, empty=(" ",), shares=20, salts=8)
        want = a.join(r, keys, "left").select(got.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert [r[0] for r in HK.heavy_keys(a.where("serial <> ' '"), ["serial"], 20).collect()] == ["hot"]
    with pytest.raises(ValueError):
        HK.heavy_left_join(a, b, ["serial"])


def test_heavy_rows_are_dealt(spark):
    """No (key, part) holds more than a small share of a key with a third of the rows."""
    a = spark.range(0, 9000, numPartitions=4).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    b = spark.createDataFrame([("hot", "x")], "k string, name string")
    got = HK.heavy_left_join(a, b, ["k"], shares=100, salts=10)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_part" in plan and got.where("name = 'x'").count() == 3000
    empty = HK.heavy_left_join(a.limit(0), b, ["k"])
    assert empty.columns == ["id", "k", "name"] and empty.count() == 0


# sheets ---------------------------------------------------------------------------
def _sheet(tmp_path, *texts):
    for i, t in enumerate(texts):
        (tmp_path / f"s{i}.csv").write_text(t, encoding="utf-8")
    return str(tmp_path)


SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("amount", T.DecimalType(10, 2)), T.StructField("name", T.StringType())])


def test_rows_and_rejects(spark, tmp_path):
    path = _sheet(tmp_path, ' Name ,ID,Extra,amount\n"a, ""b""",1,x,2.50\n\nc,two,x,\n short,3\nd,4,x,1.5,more\ne, 5 ,x,"1,5"\n',
                  "name,id,extra,amount\nf,6,,7\n")
    got = sheets.read_checked_sheet(spark, path, SCHEMA)
    rows = {(r["_file"][-6:], r["_line"]): (r["id"], r["amount"], r["name"]) for r in got.rows.collect()}
    assert rows == {("s0.csv", 2): (1, Decimal("2.50"), 'a, "b"'), ("s0.csv", 4): (None, None, "c"), ("s0.csv", 7): (5, None, "e"),
                    ("s1.csv", 2): (6, Decimal("7.00"), "f")}
    bad = sorted((r["line"], r["column"], r["text"]) for r in got.rejects.collect())
    assert bad == [(4, "id", "two"), (5, "*", " short,3"), (6, "*", "d,4,x,1.5,more"), (7, "amount", "1,5")]


def test_own_parser_and_lines_over_splits(spark, tmp_path):
    path = _sheet(tmp_path, "id;amount;name\n" + "".join(f"{i};{i},5;n{i}\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = sheets.read_checked_sheet(spark, path, SCHEMA, sep=";", parsers={"amount": lambda c: F.replace(c, F.lit(","), F.lit(".")).try_cast("decimal(10,2)")})
        assert got.rows.rdd.getNumPartitions() > 1
        rows = got.rows.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 3000 and all(r["_line"] == r["id"] + 2 and r["amount"] == Decimal(f"{r['id']}.50") for r in rows)


@pytest.mark.parametrize("texts", [("id,amount\n1,2\n",), ("id,amount,name,ID\n",), ("id,amount,name\n", "id,name,amount\n"), ("",)])
def test_header_check(spark, tmp_path, texts):
    with pytest.raises(sheets.SheetHeaderError):
        sheets.read_checked_sheet(spark, _sheet(tmp_path, *texts), SCHEMA)
