"""Loads: refused writes, one read of the source, counters from what was written, version
guard, epochs that run again, key ranges of partitions."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from tierwise.operators import merge as M
from tierwise.operators.ingest import ingest
from tierwise.plans.products import PRODUCTS, load_product
from tierwise.session import scratch_path, shared_dir
from tierwise.sources.catalog import TableSpec
from tierwise.sources.store import StoreError, VersionedTable
from tierwise.streaming.incremental import incremental_ingest, published

TS = dt.datetime
SPEC = TableSpec("t", ("k",), audit_col="d")
ROWS = "k int, d timestamp_ntz, v string"


def rows(spark, *data):
    return spark.createDataFrame([(k, TS(2024, 1, 1) + dt.timedelta(days=n), v) for k, n, v in data], ROWS)


def content(table):
    return sorted((r["k"], r["d"].day, r["v"]) for r in table.read().collect())


def test_a_refused_write_is_no_empty_batch(spark):
    class Refuses(VersionedTable):
        def _publish(self, manifest):
            raise StoreError("concurrent writer")
    with pytest.raises(StoreError):
        ingest(SPEC, rows(spark, (1, 0, "a")), Refuses(spark, scratch_path(spark, "refuses")), "2024-02-01 00:00:00")
    empty = ingest(SPEC, rows(spark, (1, 0, "a")).limit(0), VersionedTable(spark, scratch_path(spark, "empty")), "2024-02-01 00:00:00")
    assert empty.status == "EMPTY_BATCH_KEPT_OLD"


def test_a_load_reads_its_source_once_and_leaves_no_copies(spark):
    """The source answers differently each time it is read; one answer is loaded."""
    n = spark.sparkContext.accumulator(0)

    def read(batches):
        n.add(1)
        yield from batches

    source = rows(spark, *[(i % 50, i % 9, f"v{i}") for i in range(90)]).coalesce(1).mapInArrow(read, ROWS)
    before = set(glob.glob(f"{shared_dir(spark)}/tierwise/batch-*"))
    target = VersionedTable(spark, scratch_path(spark, "once"))
    one = ingest(TableSpec("t", ("k",)), source, target, "2024-02-01 00:00:00")
    assert (one.extracted, one.inserted, one.saved, one.status, n.value) == (90, 50, 50, "DIVERGENT", 1)
    two = ingest(TableSpec("t", ("k",)), source.withColumn("k", F.col("k") + 10), target, "2024-02-02 00:00:00")
    assert (two.extracted, two.inserted, two.updated, two.saved, two.removed, n.value) == (90, 10, 40, 60, 0, 2)
    assert set(glob.glob(f"{shared_dir(spark)}/tierwise/batch-*")) == before


@pytest.mark.parametrize("part", [None, "d"])
def test_counters_of_a_merge_with_a_sweep(spark, part):
    target = VersionedTable(spark, scratch_path(spark, "sweep"), partition_col=part)
    ingest(SPEC, rows(spark, (1, 0, "a"), (2, 20, "a"), (3, 40, "a"), (4, 70, "a")), target, "2024-03-15 00:00:00")
    second = rows(spark, (1, 0, "a"), (3, 41, "b"), (5, 42, "b"), (6, 43, "b"))
    r = ingest(SPEC, second, target, "2024-03-15 00:00:00", sweep=True)
    assert (r.extracted, r.inserted, r.updated, r.removed, r.saved) == (3, 2, 1, 2, 4)
    assert [c[0] for c in content(target)] == [1, 3, 5, 6]
    with pytest.raises(M.MergeError):
        ingest(SPEC, second.limit(0), target, "2024-03-15 00:00:00", sweep=True)


def test_version_guard(spark):
    target = rows(spark, (1, 10, "t"), (2, 10, "t"), (3, 10, "t")).unionByName(spark.createDataFrame([(4, None, "t"), (5, TS(2024, 1, 3), "t")], ROWS))
    batch = rows(spark, (1, 9, "older"), (2, 10, "equal"), (3, 11, "newer"), (4, 0, "known"), (6, 0, "new"), (6, 1, "newer")).unionByName(spark.createDataFrame([(5, None, "unknown")], ROWS))
    got = M.upsert(target, batch, ["k"], ["d"], descending=True, guard="d")
    assert {r["k"]: r["v"] for r in got.collect()} == {1: "t", 2: "equal", 3: "newer", 4: "known", 5: "t", 6: "newer"}


def test_late_and_repeated_files(spark):
    root = scratch_path(spark, "late")
    target = VersionedTable(spark, f"{root}/t")
    files = [rows(spark, (1, 5, "five"), (2, 5, "five"), (2, 6, "six")), rows(spark, (1, 3, "three"), (3, 3, "three")),
             rows(spark, (1, 5, "five"), (2, 5, "five"), (2, 6, "six")), rows(spark, (1, 7, "seven"), (3, 2, "two"))]
    seen = []
    for n, f in enumerate(files):
        f.write.parquet(f"{root}/in/{n}")
        incremental_ingest(spark, SPEC, f"{root}/in", f.schema, target, "2024-02-01 00:00:00", f"{root}/c", newest_wins=True)
        seen.append((target.current_version(), [c[0::2] for c in content(target)]))
    assert seen == [(1, [(1, "five"), (2, "six")]), (2, [(1, "five"), (2, "six"), (3, "three")]), (2, [(1, "five"), (2, "six"), (3, "three")]),
                    (3, [(1, "seven"), (2, "six"), (3, "three")])]
    with pytest.raises(ValueError):
        incremental_ingest(spark, TableSpec("t", ("k",)), f"{root}/in", f.schema, target, "2024-02-01 00:00:00", f"{root}/c", newest_wins=True)


def test_an_epoch_that_runs_again_publishes_nothing(spark):
    root = scratch_path(spark, "again")
    target = VersionedTable(spark, f"{root}/t")

    def run(n, f):
        f.write.parquet(f"{root}/in/{n}")
        return incremental_ingest(spark, SPEC, f"{root}/in", f.schema, target, "2024-02-01 00:00:00", f"{root}/c")

    run(0, rows(spark, (1, 0, "a")))
    run(1, rows(spark, (2, 0, "a")))
    (stream_id, epoch), = target.meta()["streams"].items()
    assert target.current_version() == 2 and published(target, stream_id, epoch) and not published(target, stream_id, epoch + 1) and not published(target, "other", 0)
    # the crash: the version is there, the checkpoint's commit of the epoch is not
    for name in glob.glob(f"{root}/c/commits/*{epoch}*") + glob.glob(f"{root}/c/commits/.{epoch}*"):
        os.replace(name, f"{root}/lost-{os.path.basename(name)}")
    assert incremental_ingest(spark, SPEC, f"{root}/in", rows(spark).schema, target, "2024-02-01 00:00:00", f"{root}/c") == []
    assert target.current_version() == 2
    # a batch load in between keeps the note
    ingest(TableSpec("t", ("k",)), rows(spark, (9, 0, "batch")), target, "2024-02-01 00:00:00")
    assert target.meta()["streams"] == {stream_id: epoch}
    run(2, rows(spark, (3, 0, "a")))
    assert [c[0] for c in content(target)] == [1, 2, 3, 9] and target.meta()["streams"][stream_id] > epoch


def test_only_partitions_whose_key_range_meets_the_batch_are_searched(spark):
    data = rows(spark, *[(n * 10 + i, 31 * n, "a") for n in range(6) for i in range(5)])
    target = VersionedTable(spark, scratch_path(spark, "ranges"), partition_col="d")
    ingest(SPEC, data, target, "2024-08-01 00:00:00")
    m = target.manifest()["parts"]
    assert [m[p]["ranges"]["k"] for p in sorted(m)] == [[str(10 * n), str(10 * n + 4)] for n in range(6)]
    month = sorted(m)
    assert target.parts_meeting(rows(spark, (21, 160, "b"), (44, 160, "b"), (9, 0, "between")), ["k"]) == [month[2], month[4]]
    assert target.parts_meeting(rows(spark, (7, 160, "b"), (1000, 160, "b")), ["k"]) == []
    # a row that moves leaves its old month, which its key finds
    r = ingest(SPEC, rows(spark, (21, 160, "moved"), (777, 160, "new")), target, "2024-07-01 00:00:00")
    assert (r.inserted, r.updated, r.saved) == (1, 1, 31) and {c[2] for c in content(target) if c[0] in (21, 777)} == {"moved", "new"}
    now = target.manifest()["parts"]
    assert {p for p in now if now[p]["v"] == 2} == {month[2], month[5]}
    assert now[month[5]]["ranges"]["k"] == ["21", "777"]


def test_partitions_written_without_ranges_may_hold_any_key(spark):
    target = VersionedTable(spark, scratch_path(spark, "plain"), partition_col="d")
    target.write(rows(spark, (1, 0, "a"), (2, 40, "a")))
    assert len(target.parts_meeting(rows(spark, (99, 0, "x")), ["k"])) == 2


def test_a_product_keeps_a_column_it_gained(spark):
    name = next(n for n, s in PRODUCTS.items() if s.load == "upsert" and not s.order)
    keys = list(PRODUCTS[name].keys)
    target = VersionedTable(spark, scratch_path(spark, "gained"))
    old = spark.createDataFrame([tuple("a" for _ in keys) + ("x",), tuple("b" for _ in keys) + ("x",)], [*keys, "V"])
    load_product(name, old, target, "2024-01-01 00:00:00")
    load_product(name, old.where(F.col(keys[0]) == "a").withColumn("NEW", F.lit(1)), target, "2024-01-02 00:00:00")
    assert sorted((r[keys[0]], r["NEW"]) for r in target.read().collect()) == [("a", 1), ("b", None)]
