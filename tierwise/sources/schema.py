"""Schema mapping: source dictionary -> Spark types, column profiles, drift policy.

* SRC-19: a data-dictionary DataFrame (column, type, length, precision, scale)
  is mapped to a ``StructType`` with the source rules;
* SRC-20: one aggregate pass (``max(length(c))`` for every text column) gives
  the sink type of each column;
* SNK-09: schema drift between a batch and its target is checked against a
  policy (``fail`` / ``add_nullable`` / ``ignore``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the source type rules.
TEXT_LIMIT = 4000          # above: CLOB
TEXT_MARGIN_PROFILE = 20   # profiled text: max length + 20
TEXT_MARGIN_SOURCE = 10    # declared text: declared length + 10
TEXT_DEFAULT = 100         # empty / unmeasurable text column
NUMERIC_DEFAULT = (38, 10)
INTEGER_MAX_PRECISION = 18


def source_type_to_spark(data_type: str, precision: int | None, scale: int | None) -> T.DataType:
    """Declared source column type -> Spark type (SRC-19 rules)."""
    t = (data_type or "").upper()
    if t == "NUMBER":
        if (scale in (0, None)) and (precision is None or precision <= INTEGER_MAX_PRECISION):
            return T.LongType()
        return T.DecimalType(precision or NUMERIC_DEFAULT[0],
                             scale if scale is not None else NUMERIC_DEFAULT[1])
    if t == "DATE" or t.startswith("TIMESTAMP"):
        return T.TimestampNTZType()
    return T.StringType()


def source_type_to_sink(data_type: str, precision, scale, length) -> str:
    """Declared source type -> sink type text (SRC-19, used for DDL/metadata)."""
    t = (data_type or "").upper()
    if t == "NUMBER":
        if (scale in (0, None)) and (precision is None or precision <= INTEGER_MAX_PRECISION):
            return "INTEGER"
        return f"NUMERIC({precision or NUMERIC_DEFAULT[0]},{scale if scale is not None else NUMERIC_DEFAULT[1]})"
    if t == "DATE" or t.startswith("TIMESTAMP"):
        return "DATETIME"
    if t in ("CLOB", "NCLOB", "LONG"):
        return "CLOB"
    if t in ("VARCHAR2", "NVARCHAR2", "CHAR", "NCHAR", "VARCHAR"):
        n = int(length or 0)
        return "CLOB" if n > TEXT_LIMIT else f"VARCHAR({n + TEXT_MARGIN_SOURCE})"
    return f"VARCHAR({TEXT_LIMIT})"


def dictionary_to_schema(dictionary, table: str) -> T.StructType:
    """Build the StructType of one table from dictionary rows (a DataFrame or
    already collected rows).

    The dictionary is tiny (one row per column); it is the only collected input
    in the library and its size is the number of columns of the tables.
    """
    if isinstance(dictionary, DataFrame):
        dictionary = dictionary.select("table_name", "column_name", "data_type", "data_precision",
                                       "data_scale", "column_id").collect()
    rows = sorted((r for r in dictionary if r["table_name"] == table), key=lambda r: r["column_id"])
    return T.StructType([T.StructField(r["column_name"],
                                       source_type_to_spark(r["data_type"], r["data_precision"],
                                                            r["data_scale"]), True)
                         for r in rows])


def spark_type_to_sink(dt: T.DataType, max_len: int | None) -> str:
    """Profiled batch column -> sink type text (SRC-20)."""
    if isinstance(dt, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return "INTEGER"
    if isinstance(dt, (T.DoubleType, T.FloatType, T.DecimalType)):
        return f"NUMERIC({NUMERIC_DEFAULT[0]},{NUMERIC_DEFAULT[1]})"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "DATETIME"
    if isinstance(dt, T.StringType):
        if max_len is None or max_len == 0:
            return f"VARCHAR({TEXT_DEFAULT})"
        return "CLOB" if max_len > TEXT_LIMIT else f"VARCHAR({max_len + TEXT_MARGIN_PROFILE})"
    return f"VARCHAR({TEXT_LIMIT})"


def column_profile(df: DataFrame, table: str) -> DataFrame:
    """One row per column: (table_name, column_name, ordinal, max_length, sink_type).

    All text lengths come from a single ``agg`` pass over the table (partial
    aggregation per task, one tiny final stage); the per-column rows are then
    produced by ``stack`` on the one-row result.  Nothing is collected.
    """
    fields = df.schema.fields
    aggs = [F.max(F.length(F.col(f.name))).alias(f"_l{i}") if isinstance(f.dataType, T.StringType)
            else F.lit(None).cast("int").alias(f"_l{i}") for i, f in enumerate(fields)]
    one = df.agg(*aggs)
    rows = []
    for i, f in enumerate(fields):
        ln = F.col(f"_l{i}")
        if isinstance(f.dataType, T.StringType):
            sink = (F.when(ln.isNull() | (ln == 0), F.lit(f"VARCHAR({TEXT_DEFAULT})"))
                    .when(ln > TEXT_LIMIT, F.lit("CLOB"))
                    .otherwise(F.concat(F.lit("VARCHAR("), (ln + TEXT_MARGIN_PROFILE).cast("string"),
                                        F.lit(")"))))
        else:
            sink = F.lit(spark_type_to_sink(f.dataType, None))
        rows.append(F.struct(F.lit(table).alias("table_name"), F.lit(f.name).alias("column_name"),
                             F.lit(i + 1).alias("ordinal"), ln.alias("max_length"),
                             sink.alias("sink_type")))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


# ---------------------------------------------------------------------------
# SNK-09: drift policy
# ---------------------------------------------------------------------------
class SchemaDriftError(ValueError):
    pass


def align_to_target(batch: DataFrame, target_schema: T.StructType, policy: str = "fail") -> DataFrame:
    """Align a batch to a target schema.

    * ``fail``: a new batch column or a missing target column raises (merge
      targets: the column must be added to the target first);
    * ``add_nullable``: new columns are kept (the target absorbs them, NULL for
      old rows) -- the behaviour of fully replaced tables;
    * ``ignore``: new columns are dropped.
    Target columns absent from the batch are always filled with typed NULLs
    except under ``fail``.
    """
    tcols = [f.name for f in target_schema.fields]
    new = [c for c in batch.columns if c not in tcols]
    missing = [c for c in tcols if c not in batch.columns]
    if policy == "fail" and (new or missing):
        raise SchemaDriftError(f"schema drift: new={new} missing={missing}")
    sel = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in batch.columns
           else F.lit(None).cast(f.dataType).alias(f.name) for f in target_schema.fields]
    if policy == "add_nullable":
        sel += [F.col(c) for c in new]
    return batch.select(*sel)


def union_drift(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old-shape rows UNION new-shape rows; columns only one side has become NULL."""
    return old.unionByName(new, allowMissingColumns=True)
