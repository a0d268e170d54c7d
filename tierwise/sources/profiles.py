"""Column profiles that add up (SRC-20).

A profile row describes one column of one part of a table (a load, a month, a storage
partition) by figures that merge without a second read of the data: counts add, lengths
take the extremes, distinct values and quantiles are sketches of fixed size (a few KB).
A table's profile after a load is its old profile merged with that of the new part; a
part that is replaced is merged anew from the remaining rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schema import TEXT_DEFAULT, TEXT_LIMIT, TEXT_MARGIN_PROFILE, spark_type_to_sink

LG_K = 12       # distinct counts to about 1.6 % (one standard error)
KLL_K = 200     # quantiles to about 1.3 % of the rows


def _figures(f: T.StructField, i: int) -> tuple[list[Column], dict[str, Column]]:
    """The aggregates of one column and the profile fields made from them."""
    c, text, number = F.col(f"`{f.name}`"), isinstance(f.dataType, T.StringType), isinstance(f.dataType, T.NumericType)
    # the sketch takes no empty text, so each gets a letter in front
    aggs = {"n_nulls": F.count_if(c.isNull()), "distinct_sketch": F.hll_sketch_agg(F.concat(F.lit("="), c.cast("string")), F.lit(LG_K))}
    if text:
        aggs |= {"n_blank": F.count_if(F.trim(c) == ""), "n_digits": F.count_if(c.rlike("^[0-9]+$")),
                 "min_length": F.min(F.length(c)), "max_length": F.max(F.length(c))}
    if number:
        aggs["quantile_sketch"] = F.kll_sketch_agg_double(c.cast("double"), F.lit(KLL_K))
    nothing = {"n_blank": F.lit(None).cast("long"), "n_digits": F.lit(None).cast("long"), "min_length": F.lit(None).cast("int"),
               "max_length": F.lit(None).cast("int"), "quantile_sketch": F.lit(None).cast("binary")}
    fields = {k: F.col(f"_{k}{i}") for k in aggs}
    return [v.alias(f"_{k}{i}") for k, v in aggs.items()], {**nothing, **fields}


_ORDER = ("n_nulls", "n_blank", "n_digits", "min_length", "max_length", "distinct_sketch", "quantile_sketch")


def part_profiles(df: DataFrame, table: str, part: Column) -> DataFrame:
    """One row per part and column, in one pass: partial aggregates per task, then one
    row per part.  Columns that cannot be text (arrays, maps, structs) are left out."""
    aggs, rows = [], []
    for i, f in enumerate(df.schema.fields):
        if not isinstance(f.dataType, T.AtomicType) or isinstance(f.dataType, (T.BinaryType, T.VariantType)):
            continue
        mine, fields = _figures(f, i)
        aggs += mine
        rows.append(F.struct(F.lit(f.name).alias("column_name"), F.lit(i + 1).alias("ordinal"),
                             F.lit(f.dataType.simpleString()).alias("data_type"), F.lit(_other_sink(f.dataType)).alias("other_sink"),
                             F.col("n_rows"), *[fields[k].alias(k) for k in _ORDER]))
    one = df.groupBy(part.cast("string").alias("part")).agg(F.count(F.lit(1)).alias("n_rows"), *aggs)
    return one.select(F.lit(table).alias("table_name"), "part", F.explode(F.array(*rows)).alias("r")).select("table_name", "part", "r.*")


def _other_sink(kind: T.DataType) -> str | None:
    """Sink type of a column whose lengths do not matter."""
    return None if isinstance(kind, T.StringType) else spark_type_to_sink(kind, None)


def merge_profiles(profiles: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Profile rows added up per table and column (and the columns of ``by``); the result
    can be merged again.  ``profiles`` may be a union of any number of frames."""
    total = [F.sum(c).alias(c) for c in ("n_rows", "n_nulls", "n_blank", "n_digits")]
    return (profiles.groupBy("table_name", *by, "column_name", "ordinal", "data_type", "other_sink")
            .agg(*total, F.min("min_length").alias("min_length"), F.max("max_length").alias("max_length"),
                 F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
                 F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch")))


def report(merged: DataFrame, quantiles: tuple[float, ...] = (0.05, 0.5, 0.95)) -> DataFrame:
    """Merged profiles without sketches: the sink type, an estimate of the distinct values
    and, for numbers, estimated quantiles (NULL without values)."""
    n = F.col("max_length")
    text = (F.when(n.isNull() | (n == 0), f"VARCHAR({TEXT_DEFAULT})").when(n > TEXT_LIMIT, "CLOB")
            .otherwise(F.concat(F.lit("VARCHAR("), (n + TEXT_MARGIN_PROFILE).cast("string"), F.lit(")"))))
    some = F.kll_sketch_get_n_double("quantile_sketch") > 0
    at = [F.when(some, F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(q))).alias(f"q{round(q * 100):02d}") for q in quantiles]
    return merged.select("table_name", "column_name", "ordinal", "data_type", "n_rows", "n_nulls", "n_blank", "n_digits", "min_length", "max_length",
                         F.coalesce("other_sink", text).alias("sink_type"), F.hll_sketch_estimate("distinct_sketch").alias("distinct_estimate"), *at)
