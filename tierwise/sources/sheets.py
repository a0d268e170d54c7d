"""Curated sheets delivered as delimited text (SRC-13/14/15).

The source system read spreadsheets with a desktop parser; here a sheet is a
CSV (or Parquet) file per tab read by Spark, so a large sheet is split across
tasks like any other input.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_text_sheet(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """All-text read (SRC-13): headers stripped and upper-cased, values trimmed."""
    df = spark.read.csv(path, header=True, inferSchema=False, sep=sep)
    df = df.toDF(*[c.strip().upper() for c in df.columns])
    return df.select(*[F.trim(F.col(f"`{c}`")).alias(c) for c in df.columns])


def read_typed_sheet(spark: SparkSession, path: str, schema: T.StructType,
                     columns: Sequence[str] | None = None, sep: str = ",") -> DataFrame:
    """Typed read with a declared schema and selected columns (SRC-14).

    Values that do not parse become NULL (PERMISSIVE), the tolerant reading of
    the source.
    """
    df = spark.read.csv(path, header=True, schema=schema, sep=sep, mode="PERMISSIVE")
    return df.select(*columns) if columns else df


def read_sheet_or_nulls(spark: SparkSession, path: str, schema: T.StructType,
                        required: bool = False, **kw) -> DataFrame | None:
    """Missing sheet: raise for dimensions, ``None`` for enrichments (SRC-15)."""
    if path_exists(spark, path):
        return read_typed_sheet(spark, path, schema, **kw)
    if required:
        raise FileNotFoundError(path)
    return None


def enrich_or_null(df: DataFrame, sheet: DataFrame | None, keys: Sequence[str],
                   columns: Mapping[str, T.DataType]) -> DataFrame:
    """Left join the sheet; a missing sheet degrades to typed NULL columns."""
    if sheet is None:
        return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items()})
    return df.join(sheet.select(*keys, *columns), on=list(keys), how="left")


def rename_present(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Dictionary rename of only the headers that exist (PRJ-02)."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def required(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows lacking a required field: NULL, blank, or the text 'nan' (FIL-10)."""
    cond = F.lit(True)
    for c in cols:
        x = F.trim(F.col(f"`{c}`").cast("string"))
        cond = cond & x.isNotNull() & (x != "") & (F.lower(x) != "nan")
    return df.where(cond)


def separator_only(key: str, sep: str = "|"):
    """True when a composite key holds nothing but separators (FIL-11)."""
    return F.trim(F.replace(F.col(f"`{key}`"), F.lit(sep), F.lit(""))) == ""


# ---------------------------------------------------------------------------
# Checked reads: typed rows and rejects
# ---------------------------------------------------------------------------
class SheetHeaderError(ValueError):
    pass


class CheckedSheet(NamedTuple):
    """``rows``: ``_file``, ``_line`` and the typed columns, one per line that has the header's
    number of fields; ``rejects``: ``file, line, column, text``, one per value that does
    not parse (it is NULL in ``rows``), and one with column ``*`` and the whole line for
    each line with another number of fields."""
    rows: DataFrame
    rejects: DataFrame


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line, value``: text lines with their number in their file, from 1.

    Lines are numbered within each split of a file (where it starts is in the file
    metadata); the splits' counts, one row per split, are cumulated per file."""
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    raw = spark.read.text(path).select("value", at.alias("at"), F.monotonically_increasing_id().alias("id"))
    raw = raw.select("at.file", "at.start", "value", "id")
    splits = raw.groupBy("file", "start").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.select("file", "start", "first", F.coalesce(before, F.lit(0)).alias("before"))
    line = F.col("before") + F.col("id") - F.col("first") + 1
    return raw.join(splits, ["file", "start"]).select("file", line.alias("line"), "value")


def _headers(lines: DataFrame, schema: T.StructType, sep: str) -> list[str]:
    """The header all files share but for case and spaces, stripped and upper-cased; each
    declared column once."""
    alike = F.upper(F.regexp_replace("value", "[\\s\ufeff]", ""))
    first = lines.where("line = 1").groupBy(alike.alias("alike")).agg(F.min("value").alias("value")).limit(2).collect()
    if len(first) != 1:
        raise SheetHeaderError("no header" if not first else "the files have different headers")
    text = first[0]["value"].removeprefix("\ufeff")
    names = [n.strip().upper() for n in next(csv.reader([text], delimiter=sep, skipinitialspace=True))]
    wanted = [n.upper() for n in schema.names]
    if missing := [n for n in wanted if n not in names]:
        raise SheetHeaderError(f"missing columns {missing}; the header has {names}")
    if twice := sorted({n for n in wanted if names.count(n) > 1}):
        raise SheetHeaderError(f"columns {twice} occur twice")
    return names


def read_checked_sheet(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
                       parsers: Mapping[str, Callable[[Column], Column]] | None = None) -> CheckedSheet:
    """Typed read of a delimited sheet that keeps what does not parse (SRC-13, SRC-14).

    The header is checked first (:class:`SheetHeaderError`): every column of ``schema``
    must be there once, whatever its case, order or neighbours; others are left out.
    Values are trimmed, empty ones are NULL and no reject.  ``parsers`` gives a column's
    own conversion of text (for example decimals of a locale); the default is a cast
    that yields NULL where it fails.  A record is a line: quotes may hold separators,
    not line ends.  Lines without any text are skipped, but counted in ``line``."""
    parsers = {k.upper(): v for k, v in (parsers or {}).items()}
    lines = _numbered_lines(spark, path)
    names = _headers(lines, schema, sep)
    fields = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))] + [T.StructField("_corrupt", T.StringType())])
    body = lines.where((F.col("line") > 1) & (F.trim("value") != ""))
    options = {"sep": sep, "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt",
               "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
    read = body.withColumn("f", F.from_csv("value", fields.simpleString(), options))
    whole = F.col("f._corrupt").isNull()
    text, typed = {}, {}
    for f in schema.fields:
        raw = F.trim(F.col(f"f.c{names.index(f.name.upper())}"))
        text[f.name] = F.when(raw != "", raw)
        parse = parsers.get(f.name.upper(), lambda c, kind=f.dataType: c.try_cast(kind))
        typed[f.name] = parse(text[f.name]).cast(f.dataType)
    rows = read.where(whole).select(F.col("file").alias("_file"), F.col("line").alias("_line"), *[typed[f.name].alias(f.name) for f in schema.fields])
    bad = [F.when(text[f.name].isNotNull() & typed[f.name].isNull(), F.struct(F.lit(f.name).alias("column"), text[f.name].alias("text")))
           for f in schema.fields]
    line = F.array(F.struct(F.lit("*").alias("column"), F.col("value").alias("text")))
    rejects = read.select("file", "line", F.explode(F.when(whole, F.array_compact(F.array(*bad))).otherwise(line)).alias("r"))
    return CheckedSheet(rows, rejects.select("file", "line", "r.column", "r.text"))
