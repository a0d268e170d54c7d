"""Versioned Parquet tables published through an atomic manifest (SNK-01..04).

Layout of a table root::

    <root>/v=000001-<attempt>/part-*.parquet     (+ _SUCCESS written by the job committer)
    <root>/v=000002-<attempt>/_part=m200107/...   (partitioned tables)
    <root>/_manifests/v=000002.json               one immutable manifest per version: its
                                                  directory, rows, load as_of and, for a
                                                  partitioned table, its partition settings
                                                  and partition -> directory

A write never touches a directory being read or one of another writer: every
attempt has a directory of its own.  After the row check it commits by creating
the manifest of the next version, which fails if that version exists already, so
of two writers that started from one version the second is refused and the first
one's files are untouched.  The current version is the highest manifest.  A
partitioned table rewrites only the partitions a merge touches; the manifest
points the others at the directories that last wrote them.  A failed or refused
attempt leaves a directory that no manifest names; :meth:`VersionedTable.vacuum`
removes those and old versions.

The rename that creates a manifest is atomic on HDFS; on a file system whose
rename checks and moves in two steps a race of that width remains.

File-system calls go through the Hadoop ``FileSystem`` of the session, so the
same code works on a local disk, HDFS or an object store.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DecimalType, IntegralType, StringType, StructField, StructType,
                               TimestampNTZType, TimestampType)

LOAD_COL_BRONZE = "DW_DATA_INGESTAO"
LOAD_COL_SILVER = "DW_DATA_PROCESSAMENTO"


def load_column_for(layer: str) -> str:
    """Name of the load-timestamp column by layer (SNK-04)."""
    return LOAD_COL_SILVER if layer.lower() in ("silver", "prata") else LOAD_COL_BRONZE


class StoreError(RuntimeError):
    pass


class EmptyBatchError(StoreError):
    """Nothing to publish: the version written has no rows (SNK-02)."""


PART_COL = "_part"
#: Key types whose smallest and largest value the manifest keeps, as text.
RANGED = (IntegralType, DecimalType, StringType, DateType, TimestampType, TimestampNTZType)


@dataclass
class VersionedTable:
    """A table of immutable versions, each published by one small manifest.

    Unpartitioned: a version is one directory.  Partitioned (``partition_col``
    set): each directory holds ``_part=...`` sub-directories and the manifest maps
    every storage partition to the directory that last wrote it.  Timestamp/date
    columns partition by month, other columns by a hash bucket.

    The settings of an existing table come from its manifest: opening it without
    them takes them over, opening it with others raises.
    """
    spark: SparkSession
    root: str
    partition_col: str | None = None
    buckets: int | None = None

    def __post_init__(self):
        m = self.manifest()
        if m is not None and m.get("parts") is not None:
            for name, default in (("partition_col", None), ("buckets", 64)):
                stored, given = m.get(name, default), getattr(self, name)
                if given is not None and given != stored:
                    raise StoreError(f"{self.root} was written with {name}={stored}, not {given}")
                setattr(self, name, stored)
        elif m is not None and self.partition_col is not None:
            raise StoreError(f"{self.root} was written without partitions")
        self.buckets = self.buckets or 64

    # -- file system ---------------------------------------------------------
    def _fs(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm

    def _path(self, *parts):
        _, jvm = self._fs()
        return jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _versions(self) -> list[int]:
        """Committed versions, in order (one listing of the manifest folder)."""
        fs, _ = self._fs()
        folder = self._path("_manifests")
        if not fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(folder)]
        return sorted(int(m[1]) for m in (re.fullmatch(r"v=(\d+)\.json", n) for n in names) if m)

    def manifest(self, version: int | None = None) -> dict | None:
        """The manifest of ``version``, or of the current one."""
        if version is None:
            versions = self._versions()
            if not versions:
                return None
            version = versions[-1]
        fs, jvm = self._fs()
        p = self._path("_manifests", f"v={version:06d}.json")
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def current_version(self) -> int | None:
        versions = self._versions()
        return versions[-1] if versions else None

    def _publish(self, manifest: dict) -> None:
        """Commit: create the manifest, unless its version exists."""
        fs, jvm = self._fs()
        version = manifest["version"]
        refused = StoreError(f"{self.root}: version {version} was published while another one was being "
                             "written (concurrent writer); nothing published")
        if (self.current_version() or 0) >= version:
            raise refused
        folder = self._path("_manifests")
        fs.mkdirs(folder)
        tmp = self._path("_manifests", f"_attempt-{uuid.uuid4().hex}")
        out = fs.create(tmp, False)
        try:
            out.write(bytearray(json.dumps(manifest, sort_keys=True), "utf-8"))
        finally:
            out.close()
        dst = self._path("_manifests", f"v={version:06d}.json")
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(dst.toUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            files.rename(tmp, dst, none)            # without OVERWRITE: fails if the version exists
        except Exception as e:
            fs.delete(tmp, False)
            if fs.exists(dst):
                raise refused from e
            raise

    def _attempt(self, version: int) -> str:
        """Name of a directory that only this write attempt uses."""
        return f"v={version:06d}-{uuid.uuid4().hex[:12]}"

    def vacuum(self, keep: int = 2, grace_hours: float = 24.0) -> list[str]:
        """Remove what the last ``keep`` versions do not need: older manifests, and
        directories that no kept manifest names and that are older than
        ``grace_hours`` (a running writer's are younger).  Returns the directories."""
        fs, jvm = self._fs()
        versions = self._versions()
        if not versions:
            return []
        used = set()
        for v in versions[-max(1, keep):]:
            m = self.manifest(v)
            used |= {m["dir"]} if m.get("parts") is None else {x["dir"] for x in m["parts"].values()}
        for v in versions[:-max(1, keep)]:
            fs.delete(self._path("_manifests", f"v={v:06d}.json"), False)
        latest = jvm.java.lang.System.currentTimeMillis() - int(grace_hours * 3_600_000)
        gone = [f.getPath().getName() for f in fs.listStatus(self._path())
                if f.getPath().getName().startswith("v=") and f.getPath().getName() not in used and f.getModificationTime() <= latest]
        for name in gone:
            fs.delete(self._path(name), True)
        return sorted(gone)

    # -- partitioning --------------------------------------------------------
    def part_expr(self, df: DataFrame):
        """Storage partition of each row (path-safe text, never NULL)."""
        c = F.col(self.partition_col)
        t = df.schema[self.partition_col].dataType
        if isinstance(t, (TimestampType, TimestampNTZType, DateType)):
            e = F.concat(F.lit("m"), F.date_format(c, "yyyyMM"))
        else:
            e = F.concat(F.lit("b"), F.pmod(F.xxhash64(c), F.lit(self.buckets)).cast("string"))
        return F.coalesce(e, F.lit("none"))

    def part_values(self, df: DataFrame) -> list[str]:
        """Storage partitions a batch touches (at most the partition count)."""
        return sorted(r[0] for r in df.select(self.part_expr(df).alias(PART_COL)).distinct().collect())

    # -- API -----------------------------------------------------------------
    def exists(self) -> bool:
        return self.manifest() is not None

    def read(self, parts: list[str] | None = None, version: int | None = None) -> DataFrame:
        """Current version (or a pinned ``version``); ``parts`` limits a
        partitioned table to those storage partitions (the others are not even
        listed).  Versions are immutable, so a pinned read is repeatable while
        writers publish newer versions."""
        m = self.manifest(version)
        if m is None:
            raise StoreError(f"{self.root} has no committed version {version or ''}".strip())
        if m.get("parts") is None:
            return self.spark.read.parquet(f"{self.root}/{m['dir']}")
        schema = StructType.fromJson(json.loads(m["schema"]))
        wanted = m["parts"] if parts is None else {k: v for k, v in m["parts"].items() if k in set(parts)}
        paths = [f"{self.root}/{v['dir']}/{PART_COL}={k}" for k, v in sorted(wanted.items())]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def schema(self) -> StructType:
        return self.read().schema

    def has_rows(self) -> bool:
        m = self.manifest()
        if m is None:
            return False
        if m.get("parts") is not None:
            return any(v["rows"] > 0 for v in m["parts"].values())
        if "rows" in m:                                      # counted when written
            return m["rows"] > 0
        return not self.read().isEmpty()

    def meta(self) -> dict:
        """What the load that published the current version noted."""
        return (self.manifest() or {}).get("meta") or {}

    def loaded_as_of(self) -> str | None:
        """The ``as_of`` of the load that published the current version (from
        the manifest: a freshness check reads no data)."""
        m = self.manifest()
        return None if m is None else (m.get("meta") or {}).get("as_of")

    def row_count(self) -> int:
        """Rows of the current version, from the manifest when recorded."""
        m = self.manifest()
        if m is None:
            return 0
        if m.get("parts") is not None:
            return sum(v["rows"] for v in m["parts"].values())
        return m["rows"] if "rows" in m else self.read().count()

    def create_empty(self, schema: StructType) -> None:
        """Create the table from a schema if absent (SNK-03)."""
        if not self.exists():
            self.write(self.spark.createDataFrame([], schema), allow_empty=True)

    def _write_parts(self, df: DataFrame, version: int, name: str, keys: Sequence[str] = ()) -> dict:
        """Write ``df`` by storage partition; returns the manifest entry of each: its
        directory, rows and the smallest and largest value of each key column."""
        path = f"{self.root}/{name}"
        # rebalance by storage partition: AQE groups each partition's rows into
        # few files, coalescing small partitions and splitting large ones, so
        # neither tasks x partitions tiny files nor one task per huge month
        df.withColumn(PART_COL, self.part_expr(df)).hint("rebalance", PART_COL).write \
          .partitionBy(PART_COL).parquet(path)
        # per-partition row counts (the SNK-01 check) and key ranges, one row per partition
        with_part = StructType([*df.schema.fields, StructField(PART_COL, StringType())])
        ranged = [k for k in keys if isinstance(df.schema[k].dataType, RANGED)]
        ends = [f(F.col(k)).cast("string").alias(f"{n}{i}") for i, k in enumerate(ranged) for n, f in (("low", F.min), ("high", F.max))]
        found = self.spark.read.schema(with_part).parquet(path).groupBy(PART_COL).agg(F.count(F.lit(1)).alias("rows"), *ends).collect()
        return {r[PART_COL]: {"v": version, "dir": name, "rows": r["rows"], "ranges": {k: [r[f"low{i}"], r[f"high{i}"]] for i, k in enumerate(ranged)}} for r in found}

    def parts_meeting(self, batch: DataFrame, keys: Sequence[str]) -> list[str]:
        """Storage partitions that may hold a key of the batch, by the key ranges in the
        manifest (MRG-01): no row of the table is read.  A partition written without
        ranges may hold any key.  The ranges are one row a partition, as in the manifest."""
        m, schema = self.manifest(), batch.schema
        parts = {p: v.get("ranges") or {} for p, v in m["parts"].items() if v["rows"]}
        known = [k for k in keys if isinstance(schema[k].dataType, RANGED) and all(None not in r.get(k, [None]) for r in parts.values())]
        if not known or not parts:
            return sorted(parts)
        rows = [(p, *(x for k in known for x in r[k])) for p, r in parts.items()]
        names = [n for i in range(len(known)) for n in (f"_low{i}", f"_high{i}")]
        ranges = self.spark.createDataFrame(rows, StructType([StructField(n, StringType()) for n in [PART_COL, *names]]))
        within = F.lit(True)
        for i, k in enumerate(known):
            kind = schema[k].dataType
            within = within & (F.col(k) >= F.col(f"_low{i}").cast(kind)) & (F.col(k) <= F.col(f"_high{i}").cast(kind))
        met = batch.select(*known).dropna().distinct().join(F.broadcast(ranges), within).select(PART_COL).distinct()
        return sorted(r[0] for r in met.collect())                   # at most the partitions

    def write(self, df: DataFrame, allow_empty: bool = False,
              expected_rows: int | None = None, before_publish=None, meta: dict | None = None,
              keys: Sequence[str] = ()) -> int:
        """Write ``df`` as the next full version and publish it; returns rows saved.

        An empty result aborts and keeps the old version (SNK-02) unless
        ``allow_empty``.  When ``expected_rows`` is given a mismatch aborts
        before publishing (SNK-01 row check).  ``before_publish`` (a callable)
        runs after the files are written and before the manifest flips: raising
        there leaves the old version current.  ``keys`` are the columns whose ranges
        a partitioned table keeps for :meth:`parts_meeting`.
        """
        nxt = (self.current_version() or 0) + 1
        name = self._attempt(nxt)
        if self.partition_col:
            parts = self._write_parts(df, nxt, name, keys)
            saved = sum(v["rows"] for v in parts.values())
            manifest = {"version": nxt, "parts": parts, "schema": df.schema.json(),
                        "partition_col": self.partition_col, "buckets": self.buckets}
        else:
            df.write.parquet(f"{self.root}/{name}")
            saved = self.spark.read.parquet(f"{self.root}/{name}").count()
            manifest = {"version": nxt, "parts": None, "rows": saved, "dir": name}
        if saved == 0 and not allow_empty:
            raise EmptyBatchError(f"refusing to publish an empty version of {self.root}")
        if expected_rows is not None and saved != expected_rows:
            raise StoreError(f"{self.root}: wrote {saved} rows, expected {expected_rows}")
        if before_publish is not None:
            before_publish()
        if meta:
            manifest["meta"] = meta
        self._publish(manifest)
        return saved

    def write_partitions(self, df: DataFrame, touched: list[str], meta: dict | None = None, keys: Sequence[str] = ()) -> int:
        """Replace only the ``touched`` storage partitions by ``df`` (which must
        hold exactly their new content) and publish; returns total table rows.

        The caller names every partition that held a row of ``df`` before; a row
        that lands in any other partition stops the publish.
        """
        m = self.manifest()
        if not self.partition_col or m is None or m.get("parts") is None:
            raise StoreError("write_partitions needs an existing partitioned table")
        nxt = m["version"] + 1
        written = self._write_parts(df, nxt, self._attempt(nxt), keys)
        stray = set(written) - set(touched)
        if stray:
            raise StoreError(f"{self.root}: rows landed in untouched partitions {sorted(stray)[:5]}")
        parts = {k: v for k, v in m["parts"].items() if k not in set(touched)}
        parts.update(written)
        # a schema that gained nullable columns becomes the table schema: older
        # partition files lack them and read NULL; types change only with all files
        old_schema = StructType.fromJson(json.loads(m["schema"]))
        whole = set(m["parts"]) <= set(touched)
        schema = df.schema if whole or set(old_schema.fieldNames()) < set(df.schema.fieldNames()) else old_schema
        manifest = {"version": nxt, "parts": parts, "schema": schema.json(),
                    "partition_col": self.partition_col, "buckets": self.buckets}
        if meta:
            manifest["meta"] = meta
        self._publish(manifest)
        return sum(v["rows"] for v in parts.values())


def stamp(df: DataFrame, as_of, layer: str = "bronze") -> DataFrame:
    """Add the load timestamp column (fixed as-of, not the wall clock)."""
    return df.withColumn(load_column_for(layer), F.lit(as_of).cast("timestamp_ntz"))
