"""Sheet readers, column profile and scope counts."""

import pytest
from pyspark.sql import types as T

from tierwise.session import scratch_path
from tierwise.sources import scan, sheets
from tierwise.sources.catalog import TableSpec
from tierwise.sources.schema import column_profile


def test_text_sheet_headers_and_values(spark):
    path = scratch_path(spark, "sheet_text")
    spark.createDataFrame([(" 10 ", "12,5"), ("x", None)], "` Produto ` string, `custo_padrao ` string") \
        .coalesce(1).write.csv(path, header=True)
    df = sheets.read_text_sheet(spark, path)
    assert df.columns == ["PRODUTO", "CUSTO_PADRAO"]
    assert sorted(tuple(r) for r in df.collect() if r[0] == "10") == [("10", "12,5")]
    assert dict(df.dtypes) == {"PRODUTO": "string", "CUSTO_PADRAO": "string"}


def test_typed_sheet_and_missing_sheet(spark):
    path = scratch_path(spark, "sheet_typed")
    spark.createDataFrame([("1", "a"), ("bad", "b")], "id string, name string").coalesce(1) \
        .write.csv(path, header=True)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    df = sheets.read_sheet_or_nulls(spark, path, schema)
    got = sorted(((r.id, r.name) for r in df.collect()), key=lambda t: t[1])
    assert got == [(1, "a"), (None, "b")]                                   # tolerant parse
    missing = scratch_path(spark, "no_such_sheet")
    assert sheets.read_sheet_or_nulls(spark, missing, schema) is None
    with pytest.raises(FileNotFoundError):
        sheets.read_sheet_or_nulls(spark, missing, schema, required=True)
    base = spark.createDataFrame([(1,)], "id long")
    out = sheets.enrich_or_null(base, None, ["id"], {"name": T.StringType()})
    assert out.first()["name"] is None and out.dtypes == [("id", "bigint"), ("name", "string")]


def test_column_profile_rules(spark):
    df = spark.createDataFrame([("ab", None, 1, 2.5), ("abcd", None, 2, 1.0)],
                               "t string, e string, n long, d double")
    got = {r.column_name: (r.max_length, r.sink_type) for r in column_profile(df, "x").collect()}
    assert got == {"t": (4, "VARCHAR(24)"), "e": (None, "VARCHAR(100)"), "n": (None, "INTEGER"),
                   "d": (None, "NUMERIC(38,10)")}


def test_scope_counts_and_keyless(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "emp long, fil long")
    spec = TableSpec("v", None, company_col="emp", branch_col="fil")
    assert spec.keyless
    assert scan.scope_count(df, spec) == 1 and scan.scope_count(df, spec, widened=True) == 2
    assert scan.has_rows(df) and not scan.has_rows(df.limit(0)) and not scan.has_rows(None)


def test_jdbc_options():
    from tierwise.sources.jdbc import jdbc_options
    o = jdbc_options("jdbc:oracle:thin:@h:1521/s", "E140IPV", user="u", partition_column="NUMNFV",
                     lower_bound=1, upper_bound=1_000_000, num_partitions=64)
    assert (o["partitionColumn"], o["lowerBound"], o["upperBound"], o["numPartitions"]) == \
        ("NUMNFV", "1", "1000000", "64")
    assert "partitionColumn" not in jdbc_options("jdbc:x", "T")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "T", partition_column="K", num_partitions=4)
