"""Reading a relational source over JDBC (SRC-11, SRC-12).

The source system pulled large first loads in fixed-size chunks through one
process.  Spark reads the same table as ``num_partitions`` parallel range
queries on a numeric column; the scope and look-back predicates are applied
with ``.where`` so Spark pushes them into every range query (the database
filters, only matching rows cross the network).  Ranges of a skewed key come from
:mod:`ranges`.  A second source system is
just another call with its own URL.

Credentials and URLs are job arguments; nothing is read from the environment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .catalog import TableSpec
from .scan import window_predicate

DEFAULT_FETCH_SIZE = 10_000


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, partition_column: str | None = None,
                 lower_bound: int | None = None, upper_bound: int | None = None,
                 num_partitions: int = 1, fetch_size: int = DEFAULT_FETCH_SIZE) -> dict:
    """Reader options for one table; a partition column needs both bounds."""
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if partition_column and num_partitions > 1:
        if lower_bound is None or upper_bound is None or upper_bound < lower_bound:
            raise ValueError("a partitioned JDBC read needs lower_bound <= upper_bound")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    return opts


def read_jdbc(spark: SparkSession, spec: TableSpec, options: dict, as_of=None,
              owner_schema: str | None = None, predicates: list[str] | None = None) -> DataFrame:
    """Scoped (and, with ``as_of``, windowed) read of a catalog table.

    ``owner_schema`` prefixes the table name (the source schema is always a
    parameter).  The bounds only split the work: rows outside them are still
    read by the first and last partitions.  ``predicates`` (disjoint and complete, as
    :func:`ranges.balanced_predicates` gives them) are one parallel read each, in place of
    the even strides of the options.
    """
    opts = dict(options)
    if owner_schema and "." not in opts["dbtable"]:
        opts["dbtable"] = f"{owner_schema}.{opts['dbtable']}"
    if predicates:
        strides = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")
        rest = {k: v for k, v in opts.items() if k not in ("url", "dbtable", *strides)}
        df = spark.read.jdbc(opts["url"], opts["dbtable"], predicates=predicates, properties=rest)
    else:
        df = spark.read.format("jdbc").options(**opts).load()
    df = df.where(spec.scope())
    if as_of is not None and spec.audit_col:
        df = df.where(window_predicate(spec, as_of))
    return df.select(*spec.columns) if spec.columns else df
