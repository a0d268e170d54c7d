"""Table catalog: one frozen ``TableSpec`` per ingested table (SRC-17).

A spec carries what the loader needs to plan a refresh: merge keys (``None`` for
a keyless view), the audit column for the look-back window, an optional
fallback audit column and sentinel date, the scope (company / branch values) and
physical column-name overrides.  Scope is a Column predicate, never parsed SQL.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TableSpec:
    name: str
    keys: tuple[str, ...] | None
    audit_col: str | None = None
    fallback_col: str | None = None
    sentinel: str | None = None
    company_col: str | None = None
    company_values: tuple = (1,)
    branch_col: str | None = None
    branch_values: tuple = (1,)
    kind: str = "fact"                      # "fact" | "dimension" (cut-off only on facts)
    owner: str = "default"                  # writer of the slice (multi-writer tables)
    lookback_days: int = 60
    order: tuple[str, ...] = ()             # dedup order; defaults to the audit column
    latest_wins: bool = False               # source parity: oldest row wins on ties
    columns: tuple[str, ...] | None = None  # selected source columns (None = all)

    @property
    def keyless(self) -> bool:
        return not self.keys

    def scope(self, widened: bool = False) -> Column:
        """Scope predicate; ``widened=True`` drops the branch (REC-02)."""
        cond = F.lit(True)
        if self.company_col:
            cond = cond & F.col(self.company_col).isin(*self.company_values)
        if self.branch_col and not widened:
            cond = cond & F.col(self.branch_col).isin(*self.branch_values)
        return cond

    def dedup_order(self) -> list[str]:
        if self.order:
            return list(self.order)
        return [self.audit_col] if self.audit_col else []


@dataclass
class Catalog:
    """Registry of specs, looked up by exact name, with a size check."""
    specs: dict[str, TableSpec] = field(default_factory=dict)
    multi_writer: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def add(self, spec: TableSpec) -> TableSpec:
        key = f"{spec.owner}:{spec.name}"
        if key in self.specs:
            raise ValueError(f"duplicate catalog entry {key}")
        self.specs[key] = spec
        return spec

    def extend(self, specs: Iterable[TableSpec]) -> "Catalog":
        for s in specs:
            self.add(s)
        return self

    def get(self, name: str, owner: str | None = None) -> TableSpec:
        hits = [s for s in self.specs.values()
                if s.name == name and (owner is None or s.owner == owner)]
        if len(hits) != 1:
            raise KeyError(f"{name!r}: {len(hits)} catalog entries (owner={owner})")
        return hits[0]

    def check_size(self, expected: int) -> None:
        if len(self.specs) != expected:
            raise AssertionError(f"catalog has {len(self.specs)} entries, expected {expected}")

    def distinct_tables(self) -> set[str]:
        return {s.name for s in self.specs.values()}

    def writers(self, name: str) -> list[TableSpec]:
        return [s for s in self.specs.values() if s.name == name]
