"""Ingestion dispatch, load metrics and run summaries (SNK-05..08, MRG-07).

``ingest`` chooses the strategy the way the source loader did:

* keyless spec (a view)             -> full replace of the scoped snapshot
* target absent or empty            -> full replace (first load)
* otherwise                         -> look-back window (or snapshot when the
                                       table has no trusted audit column),
                                       merge on the keys, optional scoped sweep

The source for a table may be any reader (a second system is just another
DataFrame, MRG-04/MRG-06).  ``ingest`` returns a ``LoadResult``;
``run_tables`` / ``refresh_area`` turn several into a metrics DataFrame.

Every load reads the source once: the batch is written to the shared folder and
everything after works on that copy, so a row that arrives meanwhile cannot be in one
read and not in another; the copies are removed when the load is over.  All counters
come from what was written (rows of the copies and of the published files), none from
task metrics, so a re-run task cannot double or lose them.  On a partitioned target
only the storage partitions that the batch touches, that held one of its keys before
or that hold the sweep's orphans are rewritten; which may hold a key is read from the
key ranges in the manifest, and only those are searched.  Each published version
records the ``as_of`` of its load.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove_scratch, scratch_path
from ..sources import scan
from ..sources.catalog import TableSpec
from ..sources.drift import align_types
from ..sources.schema import align_to_target
from ..sources.store import EmptyBatchError, VersionedTable, load_column_for

TYPE_POLICIES = ("widen", "lossless")
from . import digests, merge

METRICS_SCHEMA = ("table_name string, strategy string, extracted long, inserted long, "
                  "updated long, saved long, removed long, status string, seconds double")


@dataclass
class LoadResult:
    table_name: str
    strategy: str
    extracted: int = 0
    inserted: int = 0
    updated: int = 0
    saved: int = 0
    removed: int = 0
    status: str = "OK"
    seconds: float = 0.0

    def row(self):
        return (self.table_name, self.strategy, self.extracted, self.inserted, self.updated,
                self.saved, self.removed, self.status, round(self.seconds, 3))


def _stamp(df: DataFrame, as_of, layer: str) -> DataFrame:
    return df.withColumn(load_column_for(layer), F.lit(as_of).cast("timestamp_ntz"))


def ingest(spec: TableSpec, source: DataFrame, target: VersionedTable, as_of,
           sweep: bool = False, layer: str = "bronze", drift: str = "fail",
           dedup_first_load: bool = True, guard: str | None = None, meta: dict | None = None) -> LoadResult:
    """Refresh one table and return its counters.

    ``dedup_first_load`` collapses repeated keys of a first load (a count of the
    keys; only repeated ones are shuffled whole).  Without it the snapshot is
    copied as it is, which is for sources whose keys are known to be unique.

    ``drift`` is the schema-drift policy of a merge (SNK-09): ``fail`` (a
    merge target must get a new source column first), ``add_nullable`` (the
    target absorbs it; older rows read NULL) or ``ignore`` (dropped); ``widen`` and
    ``lossless`` also settle types that differ (:mod:`tierwise.sources.drift`; a type
    that grows rewrites all partitions once).  Full replaces (first load, keyless)
    always take the source shape.

    ``guard`` names a version column: merged rows older than the table's are left
    out (:func:`merge.rows_to_apply`).  ``meta`` is noted in the published manifest.
    """
    t0 = time.time()
    # scope and window filters come first, so they reach the scan; blanks after
    clean = scan.normalize_blanks
    notes = {**{k: v for k, v in target.meta().items() if k == "streams"}, "as_of": str(as_of), **(meta or {})}
    copies: list[str] = []
    try:
        if spec.keyless or not target.has_rows():
            strategy = "keyless_replace" if spec.keyless else "first_load"
            batch, extracted = _copy(target.spark, clean(scan.snapshot_scan(source, spec)), spec.name, copies)
            if not spec.keyless and dedup_first_load:
                batch = merge.dedup_first(batch, spec.keys, spec.dedup_order(), descending=spec.latest_wins)
            try:
                saved = target.write(_stamp(batch, as_of, layer), meta=notes, keys=() if spec.keyless else spec.keys)
            except EmptyBatchError:                     # old version kept (SNK-02)
                return LoadResult(spec.name, strategy, extracted, saved=target.row_count(),
                                  status="EMPTY_BATCH_KEPT_OLD", seconds=time.time() - t0)
            # extracted vs saved divergence (SNK-06): duplicates collapsed by the key
            status = "OK" if saved == extracted else "DIVERGENT"
            return LoadResult(spec.name, strategy, extracted, saved, 0, saved, 0, status, time.time() - t0)
        if spec.audit_col:
            batch, strategy = scan.window_scan(source, spec, as_of), "window_merge"
        else:
            batch, strategy = scan.snapshot_scan(source, spec), "snapshot_merge"
        universe = clean(scan.key_universe(source, spec)) if sweep else None
        return _merge(spec, clean(batch), target, as_of, layer, strategy, t0, universe, drift, guard, notes, copies)
    finally:
        for path in copies:
            remove_scratch(target.spark, path)


def _copy(spark: SparkSession, df: DataFrame, name: str, copies: list[str]) -> tuple[DataFrame, int]:
    """``df`` written to the shared folder, and its rows; the folder is noted in ``copies``."""
    path = scratch_path(spark, f"batch-{name}")
    copies.append(path)
    df.write.parquet(path)
    df = spark.read.schema(df.schema).parquet(path)
    return df, df.count()


def _merge(spec: TableSpec, batch: DataFrame, target: VersionedTable, as_of, layer: str, strategy: str, t0: float,
           universe: DataFrame | None, drift: str, guard: str | None, notes: dict, copies: list[str]) -> LoadResult:
    """Upsert the window batch [+ scoped orphan sweep].

    The rows to apply are written once (one per key, after the version guard) and
    counted; ``inserted`` is what the table grew by, ``updated`` the rest of them.
    With a sweep the inserted keys are counted by a join of the key columns, and
    ``removed`` is what is missing from the sum.  On a partitioned table only the
    partitions the batch touches, those that hold one of its keys now and, with a
    sweep, those holding orphans are read and rewritten.
    """
    batch, extracted = _copy(target.spark, batch, spec.name, copies)
    if extracted == 0 and universe is None:
        return LoadResult(spec.name, strategy, saved=target.row_count(),
                          status="EMPTY_BATCH_KEPT_OLD", seconds=time.time() - t0)
    if universe is not None and universe.select(*spec.keys).dropna().isEmpty():
        raise merge.MergeError("refusing to sweep against an empty key universe")
    batch, grown = _stamp(batch, as_of, layer), False
    if drift in TYPE_POLICIES:
        old = target.read().schema
        batch, new = align_types(batch, target.read(), drift)
        grown = any(new.schema[f.name].dataType != f.dataType for f in old.fields)
    m, k = target.manifest(), list(spec.keys)
    parts = m.get("parts") if target.partition_col else None
    if parts is not None:
        touched = set(target.part_values(batch)) | _holding_partitions(spec, target, batch) if extracted else set()
        if universe is not None:
            touched |= _orphan_partitions(spec, target, universe)
        if grown:                                       # every partition is written anew in the wider type
            touched |= set(parts)
        touched = sorted(touched)
        current = target.read(parts=touched)
        before = sum(v["rows"] for p, v in parts.items() if p in set(touched))
        elsewhere = sum(v["rows"] for v in parts.values()) - before
        strategy += "@partitions"
    else:
        touched, current, before, elsewhere = None, target.read(), target.row_count(), 0
    if drift in TYPE_POLICIES:
        _, current = align_types(batch, current, drift)
    else:
        batch = align_to_target(batch, current.schema, drift)
        new_cols = [f for f in batch.schema.fields if f.name not in current.columns]
        current = current.withColumns({f.name: F.lit(None).cast(f.dataType) for f in new_cols})
    src = merge.rows_to_apply(current, batch, k, spec.dedup_order(), descending=spec.latest_wins, guard=guard)
    src, applied = _copy(target.spark, src, f"{spec.name}-rows", copies)
    if applied == 0 and universe is None:               # every row is older than the table's
        return LoadResult(spec.name, strategy, extracted, saved=target.row_count(), seconds=time.time() - t0)
    final = merge.replace_rows(current, src, k)
    inserted = None
    if universe is not None:
        final, _ = merge.orphan_sweep(final, universe, k, scope=spec.scope(), allow_empty_universe=True)
        inserted = src.select(*k).join(current.select(*k), on=k, how="left_anti").count()
        strategy += "+sweep"
    if touched is None:
        saved = target.write(final, allow_empty=universe is not None, meta=notes, keys=k)
    else:
        saved = target.write_partitions(final, touched, meta=notes, keys=k)
    written = saved - elsewhere
    inserted = written - before if inserted is None else inserted
    return LoadResult(spec.name, strategy, extracted, inserted, applied - inserted, saved, before + inserted - written,
                      "OK", time.time() - t0)


def _holding_partitions(spec: TableSpec, target: VersionedTable, batch: DataFrame) -> set[str]:
    """Storage partitions that hold a key of the batch now: a row whose partition
    column changed leaves its old partition.  None but the batch's own where the
    partition follows from the key; else those whose key range meets the batch are
    searched, reading their key and partition columns."""
    k = list(spec.keys)
    if target.partition_col in k:
        return set()
    near = target.parts_meeting(batch, k)
    if not near:
        return set()
    held = target.read(parts=near).select(*dict.fromkeys([*k, target.partition_col]))
    return set(target.part_values(held.join(batch.select(*k).dropna().distinct(), on=k, how="left_semi")))


def _orphan_partitions(spec: TableSpec, target: VersionedTable, universe: DataFrame) -> set[str]:
    """Storage partitions holding in-scope rows whose key left the source, found by
    key ranges first (:func:`digests.range_sweep`): rows of equal ranges are not
    shuffled.  Reads only the key, scope and partition columns of the table."""
    _, orphans = digests.range_sweep(target.read(), universe, list(spec.keys), scope=spec.scope(), allow_empty_universe=True)
    return set(target.part_values(orphans))


def metrics_frame(spark: SparkSession, results: list[LoadResult]) -> DataFrame:
    return spark.createDataFrame([r.row() for r in results], METRICS_SCHEMA)


def run_tables(spark: SparkSession, jobs, as_of, sweep: bool = False, parallelism: int = 1,
               drift: str = "fail") -> DataFrame:
    """Run several ingestions, isolating failures per table (SNK-08).

    ``jobs`` is an iterable of ``(spec, source_df_or_callable, VersionedTable)``.
    A failing table is reported with status ``ERROR`` and the run continues.
    Tables are independent: with ``parallelism`` > 1 their Spark jobs are
    submitted concurrently from a small thread pool so small tables do not
    leave the cluster idle; results keep the input order.
    """
    def one(job):
        spec, source, target = job
        t0 = time.time()
        try:
            src = source() if callable(source) else source
            return ingest(spec, src, target, as_of, sweep=sweep, drift=drift)
        except Exception as e:  # noqa: BLE001 - isolation is the point
            return LoadResult(spec.name, "error", status=f"ERROR: {type(e).__name__}",
                              seconds=time.time() - t0)

    jobs = list(jobs)
    if parallelism > 1:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            out = list(pool.map(one, jobs))
    else:
        out = [one(j) for j in jobs]
    return metrics_frame(spark, out)


def run_summary(metrics: DataFrame) -> DataFrame:
    """Totals per status (REC-13 / SNK-08)."""
    return (metrics.groupBy("status")
            .agg(F.count(F.lit(1)).alias("n_tables"), F.sum("saved").alias("saved"),
                 F.sum("removed").alias("removed")))


def refresh_area(spark: SparkSession, catalog, area: str, read_source, bronze_root: str, as_of,
                 sweep: bool = False, partition_cols: dict | None = None, parallelism: int = 1,
                 drift: str = "fail") -> DataFrame:
    """Refresh every catalog table owned by ``area`` (one bronze cycle, E1).

    ``read_source(spec)`` returns the source DataFrame of a table (any reader:
    Parquet export, JDBC, a second system).  Tables are independent jobs; a
    failure is isolated and reported in the metrics.  ``sweep`` turns the
    scoped orphan sweep on (the last cycle of the day).  ``partition_cols``
    optionally names the immutable partition column of large tables.
    """
    partition_cols = partition_cols or {}
    jobs = []
    for spec in sorted((s for s in catalog.specs.values() if s.owner == area), key=lambda s: s.name):
        target = VersionedTable(spark, f"{bronze_root}/{spec.name}",
                                partition_col=partition_cols.get(spec.name))
        jobs.append((spec, (lambda s=spec: read_source(s)), target))
    return run_tables(spark, jobs, as_of, sweep=sweep, parallelism=parallelism, drift=drift)
