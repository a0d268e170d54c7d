"""Shared pieces of the data products: parameters, bronze access, registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..bronze_schemas import BRONZE_SCHEMAS

Bronze = Callable[[str], DataFrame]


@dataclass(frozen=True)
class ProductParams:
    """Every date a product depends on is explicit (no wall clock)."""
    as_of: str = "2026-01-01 00:00:00"
    company: int = 1
    branch: int = 1
    billing_cutoff: str = "2021-01-01"          # commercial facts
    production_cutoff: str = "2021-01-01"       # production business history
    consumption_reach: str = "2018-01-01"       # production look-up reach (not a cutoff)
    performance_floor: str = "2001-01-01"       # performance block: DATREA strictly after
    reports_cutoff: str = "2023-01-01"          # RMA reports
    trace_cutoff: str = "2023-01-01"            # traceability
    opex_companies: tuple = (1, 50)
    faithful_address: bool = True


@dataclass(frozen=True)
class ProductSpec:
    name: str
    kind: str                       # "dimension" | "fact"
    load: str                       # "upsert" | "replace"
    keys: tuple[str, ...] = ()
    build: Callable = None
    inputs: tuple[str, ...] = ()    # bronze tables / sheets read
    order: tuple[str, ...] = ()     # which of several rows of a key stays: the first of this order
    descending: bool = False


@dataclass
class TableBronze:
    """Bronze accessor over Parquet tables ``<root>/<NAME>`` (current version
    through the store where it has a manifest)."""
    spark: SparkSession
    root: str
    extra: dict = field(default_factory=dict)

    def __call__(self, name: str) -> DataFrame:
        if name in self.extra:
            return self.extra[name]
        from ...sources.store import VersionedTable
        t = VersionedTable(self.spark, f"{self.root}/{name}")
        return t.read() if t.exists() else self.spark.read.parquet(f"{self.root}/{name}")


def c(alias: str, col: str) -> Column:
    return F.col(f"{alias}.{col}")


def on(left: str, right: str, *pairs) -> Column:
    """Equality of ``left.X == right.Y`` for each pair (X or (X, Y))."""
    cond = None
    for p in pairs:
        a, b = (p, p) if isinstance(p, str) else p
        e = c(left, a) == c(right, b)
        cond = e if cond is None else cond & e
    return cond
