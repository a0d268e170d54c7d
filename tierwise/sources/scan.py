"""Scoped snapshot and look-back window scans (SRC-01..10).

A scan is ``read -> filter(scope & window) -> select``: Catalyst pushes the
scope and the window into the Parquet reader (``PushedFilters``) and prunes the
columns (``ReadSchema``).  Date columns are compared uncast, so row-group
statistics still apply.  ``as_of`` is always a parameter, never "now".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from .catalog import TableSpec


def window_predicate(spec: TableSpec, as_of, days: int | None = None) -> Column:
    """``audit >= as_of - N days`` with optional fallback column and sentinel.

    * fallback (SRC-05): ``NVL(audit, fallback) >= start`` -- new rows whose audit
      column is still NULL are not lost;
    * sentinel (SRC-06): rows carrying the "no date" sentinel are always read.
    """
    if not spec.audit_col:
        raise ValueError(f"{spec.name} has no audit column: use a snapshot scan")
    start = X.lookback_start(as_of, days if days is not None else spec.lookback_days)
    audit = F.col(spec.audit_col)
    if spec.fallback_col:
        audit = F.coalesce(audit, F.col(spec.fallback_col))
    cond = audit >= start
    if spec.sentinel:
        # the sentinel day as a timestamp range keeps the predicate pushable
        lo = F.lit(spec.sentinel).cast("timestamp_ntz")
        cond = cond | ((F.col(spec.audit_col) >= lo) & (F.col(spec.audit_col) < lo + F.expr("INTERVAL 1 DAY")))
    # no NULL-to-false wrapper: WHERE drops NULL already, and a wrapper would
    # stop the predicate from reaching the Parquet reader
    return cond


def snapshot_scan(df: DataFrame, spec: TableSpec) -> DataFrame:
    """All (selected) columns inside the spec's scope (SRC-01/02/03/07/08)."""
    out = df.where(spec.scope())
    return out.select(*spec.columns) if spec.columns else out


def window_scan(df: DataFrame, spec: TableSpec, as_of, days: int | None = None) -> DataFrame:
    """Scope + look-back window (SRC-04/05/06)."""
    out = df.where(spec.scope() & window_predicate(spec, as_of, days))
    return out.select(*spec.columns) if spec.columns else out


def key_universe(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Distinct keys in scope, no date window (SRC-09): only key columns are read."""
    return df.where(spec.scope()).select(*spec.keys).distinct()


def scope_count(df: DataFrame, spec: TableSpec, widened: bool = False) -> int:
    """Row count in scope, works for keyless tables (SRC-10)."""
    return df.where(spec.scope(widened)).count()


def has_rows(df: DataFrame | None) -> bool:
    """First-load detection: the table exists and has at least one row (SRC-18)."""
    return df is not None and not df.isEmpty()


def normalize_blanks(df: DataFrame) -> DataFrame:
    """'' -> NULL on every text column at ingest (the source dialect's rule, T1)."""
    return df.withColumns({f.name: X.empty_to_null(f.name)
                           for f in df.schema.fields if f.dataType.typeName() == "string"})
