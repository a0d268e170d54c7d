"""Merge, dedup, sweep, versioned store and ingestion dispatch."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tierwise.operators import merge as M
from tierwise.operators import reconcile as R
from tierwise.operators.ingest import ingest, run_summary, run_tables
from tierwise.session import scratch_path
from tierwise.sources import scan
from tierwise.sources.catalog import Catalog, TableSpec
from tierwise.sources.schema import SchemaDriftError, align_to_target, source_type_to_spark
from tierwise.sources.store import StoreError, VersionedTable

TS = dt.datetime
SCHEMA = "k1 long, k2 string, v decimal(18,4), audit timestamp_ntz"


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_dedup_first_oldest_wins_and_latest_option(spark):
    df = spark.createDataFrame([(1, "a", Decimal("1"), TS(2024, 1, 2)), (1, "a", Decimal("2"), TS(2024, 1, 1)),
                                (1, "a", Decimal("3"), None), (2, "b", Decimal("4"), TS(2024, 1, 1))], SCHEMA)
    first = {r["k1"]: r["v"] for r in M.dedup_first(df, ["k1", "k2"], ["audit"]).collect()}
    latest = {r["k1"]: r["v"] for r in M.dedup_first(df, ["k1", "k2"], ["audit"], descending=True).collect()}
    assert first == {1: Decimal("2.0000"), 2: Decimal("4.0000")}      # ASC NULLS LAST
    assert latest[1] == Decimal("3.0000")                             # DESC NULLS FIRST


def test_dedup_is_partitioning_independent(spark):
    df = spark.createDataFrame([(1, "a", Decimal(i % 3), TS(2024, 1, 1)) for i in range(30)], SCHEMA)
    a = sorted_rows(M.dedup_first(df, ["k1", "k2"], ["audit"]))
    b = sorted_rows(M.dedup_first(df.repartition(7), ["k1", "k2"], ["audit"]))
    assert a == b and len(a) == 1


def test_upsert_update_insert_never_delete_and_idempotent(spark):
    target = spark.createDataFrame([(1, "a", Decimal("1"), TS(2024, 1, 1)), (2, "b", Decimal("2"), TS(2024, 1, 1)),
                                    (3, "c", Decimal("3"), TS(2024, 1, 1))], SCHEMA)
    batch = spark.createDataFrame([(2, "b", Decimal("20"), TS(2024, 2, 1)), (4, "d", Decimal("4"), TS(2024, 2, 1)),
                                   (4, "d", Decimal("5"), TS(2024, 2, 2))], SCHEMA)
    once = M.upsert(target, batch, ["k1", "k2"], ["audit"])
    twice = M.upsert(once, batch, ["k1", "k2"], ["audit"])
    got = {r["k1"]: r["v"] for r in once.collect()}
    assert got == {1: Decimal("1.0000"), 2: Decimal("20.0000"), 3: Decimal("3.0000"), 4: Decimal("4.0000")}
    assert sorted_rows(once) == sorted_rows(twice)


def test_upsert_refuses_null_keys(spark):
    target = spark.createDataFrame([(1, "a", Decimal("1"), TS(2024, 1, 1))], SCHEMA)
    batch = spark.createDataFrame([(None, "a", Decimal("1"), TS(2024, 1, 1))], SCHEMA)
    with pytest.raises(M.MergeError):
        M.upsert(target, batch, ["k1", "k2"])
    filled = M.fill_null_keys(spark.createDataFrame([(None, 1)], "k string, v int"), ["k"])
    assert filled.first()["k"] == " "                                 # MRG-09


def test_insert_if_absent_idempotent(spark):
    t = spark.createDataFrame([(1, 1)], "grp long, mem long")
    b = spark.createDataFrame([(1, 1), (1, 2), (1, 2)], "grp long, mem long")
    once = M.insert_if_absent(t, b, ["grp", "mem"])
    assert sorted_rows(once) == [(1, 1), (1, 2)]
    assert sorted_rows(M.insert_if_absent(once, b, ["grp", "mem"])) == [(1, 1), (1, 2)]


def test_orphan_sweep_keeps_other_scope_and_refuses_empty_universe(spark):
    target = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "z", 3)], "company int, k string, v int")
    universe = spark.createDataFrame([(1, "a")], "company int, k string")
    kept, removed = M.orphan_sweep(target, universe, ["company", "k"], scope=F.col("company") == 1)
    assert sorted_rows(kept) == [(1, "a", 1), (2, "z", 3)]
    assert sorted_rows(removed) == [(1, "b", 2)]
    with pytest.raises(M.MergeError):
        M.orphan_sweep(target, universe.limit(0), ["company", "k"])


def test_key_grain_report_and_tie_break(spark):
    df = spark.createDataFrame([(1, "p", "d2"), (1, "p", "d1"), (1, "q", "d9")], "emp int, pro string, der string")
    assert sorted_rows(M.key_grain_report(df, ["emp", "pro"])) == [(1, "p", 2)]
    ref = spark.createDataFrame([(1, "p", "d2")], "emp int, pro string, der string")
    got = sorted_rows(M.tie_break_reference(df, ["emp", "pro"], "der", ref))
    assert got == [(1, "p", "d2"), (1, "q", "d9")]                    # preferred beats smaller


def test_store_versions_and_empty_guard(spark):
    t = VersionedTable(spark, scratch_path(spark, "store_test"))
    assert not t.exists()
    t.write(spark.createDataFrame([(1,), (2,)], "x int"))
    t.write(spark.createDataFrame([(3,)], "x int"))
    assert t.current_version() == 2 and [r[0] for r in t.read().collect()] == [3]
    with pytest.raises(StoreError):
        t.write(spark.createDataFrame([], "x int"))
    assert [r[0] for r in t.read().collect()] == [3]                   # old data kept (SNK-02)


def test_window_scan_fallback_and_sentinel(spark):
    as_of = "2024-03-01 12:00:00"
    df = spark.createDataFrame([
        (1, TS(2024, 2, 1), TS(2023, 1, 1)), (2, TS(2024, 1, 1, 12), TS(2023, 1, 1)),
        (3, TS(2024, 1, 1, 11), TS(2023, 1, 1)), (4, None, TS(2024, 2, 20)), (5, TS(1900, 12, 31), TS(2023, 1, 1))],
        "id long, changed timestamp_ntz, created timestamp_ntz")
    plain = TableSpec("t", ("id",), audit_col="changed")
    fb = TableSpec("t", ("id",), audit_col="changed", fallback_col="created")
    sen = TableSpec("t", ("id",), audit_col="changed", sentinel="1900-12-31")
    ids = lambda spec: sorted(r[0] for r in scan.window_scan(df, spec, as_of).collect())
    assert ids(plain) == [1, 2]                # exactly at as_of - 60 days keeps the time of day (T8)
    assert ids(fb) == [1, 2, 4]
    assert ids(sen) == [1, 2, 5]


def test_ingest_first_load_then_merge_and_sweep(spark):
    spec = TableSpec("t", ("id",), audit_col="changed", company_col="company", company_values=(1,))
    src1 = spark.createDataFrame([(1, 1, "a", TS(2024, 1, 1)), (2, 1, "", TS(2024, 1, 1)), (3, 2, "x", TS(2024, 1, 1))],
                                 "id long, company int, v string, changed timestamp_ntz")
    target = VersionedTable(spark, scratch_path(spark, "ingest_test"))
    r1 = ingest(spec, src1, target, "2024-01-10 00:00:00")
    assert (r1.strategy, r1.extracted, r1.saved) == ("first_load", 2, 2)
    assert target.read().where("id = 2").first()["v"] is None          # '' -> NULL at ingest
    src2 = spark.createDataFrame([(1, 1, "b", TS(2024, 1, 9)), (4, 1, "n", TS(2024, 1, 9))],
                                 "id long, company int, v string, changed timestamp_ntz")
    r2 = ingest(spec, src2, target, "2024-01-10 00:00:00", sweep=True)
    assert (r2.extracted, r2.inserted, r2.updated, r2.removed, r2.saved) == (2, 1, 1, 1, 2)
    assert sorted((r["id"], r["v"]) for r in target.read().collect()) == [(1, "b"), (4, "n")]
    metrics = run_tables(spark, [(spec, lambda: 1 / 0, target)], "2024-01-10 00:00:00")
    assert metrics.first()["status"].startswith("ERROR")               # failure isolated (SNK-08)
    assert run_summary(metrics).count() == 1


def test_reconcile_distinct_vs_strict(spark):
    a = spark.createDataFrame([(1, None), (2, 5.0), (2, 5.0)], "k int, v double")
    b = spark.createDataFrame([(1, None), (2, 5.0), (3, 1.0)], "k int, v double")
    assert sorted_rows(R.symmetric_diff(a, b)) == [(3, 1.0, "only_in_b")]          # NULL = NULL (T5)
    assert sorted_rows(R.symmetric_diff(a, b, strict=True)) == [(2, 5.0, "only_in_a"), (3, 1.0, "only_in_b")]


def test_count_check_alert_and_multi_writer(spark):
    src = spark.createDataFrame([(1, 1), (1, 2), (1, 3)], "company int, branch int")
    chk = R.count_check("t", src, src.where("branch = 1"), scope=F.expr("branch = 1"),
                        widened_scope=F.expr("company = 1")).first()
    assert (chk["status"], chk["alert"]) == ("OK", True)               # REC-02 alerts, REC-01 does not
    mw = R.count_check("t", src, src, scope=F.expr("branch = 1"), multi_writer=True).first()
    assert mw["status"] == "OK"


def test_schema_drift_policy(spark):
    target = spark.createDataFrame([(1,)], "a long").schema
    batch = spark.createDataFrame([(1, "x")], "a long, b string")
    with pytest.raises(SchemaDriftError):
        align_to_target(batch, target, "fail")
    assert align_to_target(batch, target, "add_nullable").columns == ["a", "b"]
    assert align_to_target(batch, target, "ignore").columns == ["a"]
    assert source_type_to_spark("NUMBER", 10, 0).typeName() == "long"
    assert source_type_to_spark("NUMBER", 15, 2).simpleString() == "decimal(15,2)"


def test_catalog_lookup_and_size():
    cat = Catalog().extend([TableSpec("A", ("k",)), TableSpec("B", None), TableSpec("A", ("k",), owner="other")])
    cat.check_size(3)
    assert cat.get("B").keyless and len(cat.writers("A")) == 2
    with pytest.raises(KeyError):
        cat.get("A")


def test_partitioned_merge_rewrites_only_touched_partitions(spark, sf_small):
    orders = spark.read.parquet(f"{sf_small}/orders.parquet")
    spec = TableSpec("orders", ("o_orderkey",), audit_col="o_orderdate")
    flat = VersionedTable(spark, scratch_path(spark, "flat"))
    part = VersionedTable(spark, scratch_path(spark, "part"), partition_col="o_orderdate")
    as_of = "2001-08-01 00:00:00"
    cut = F.lit("2001-07-01 00:00:00").cast("timestamp_ntz")
    first = orders.where(F.col("o_orderdate") < cut)
    for t in (flat, part):
        ingest(spec, first, t, as_of)
    before = part.manifest()["parts"]
    changed = orders.withColumn("o_orderpriority", F.lit("9-CHANGED"))       # window: last 60 days
    r_flat = ingest(spec, changed, flat, as_of)
    r_part = ingest(spec, changed, part, as_of)
    assert r_part.strategy == "window_merge@partitions"
    assert (r_part.extracted, r_part.inserted, r_part.updated, r_part.saved) == \
        (r_flat.extracted, r_flat.inserted, r_flat.updated, r_flat.saved)
    a, b = flat.read(), part.read()
    assert a.exceptAll(b.select(*a.columns)).isEmpty() and b.select(*a.columns).exceptAll(a).isEmpty()
    after = part.manifest()["parts"]
    rewritten = {k for k in after if after[k]["v"] == 2}
    assert rewritten == {"m200106", "m200107", "m200108"}                  # only the window's months
    assert all(after[k] == before[k] for k in before if k not in rewritten)
    assert part.read(parts=["m200107"]).count() == orders.where(
        F.date_format("o_orderdate", "yyyyMM") == "200107").count()


def test_partitioned_write_refuses_stray_rows(spark):
    t = VersionedTable(spark, scratch_path(spark, "stray"), partition_col="d")
    df = spark.createDataFrame([(1, TS(2024, 1, 5)), (2, TS(2024, 2, 5))], "k long, d timestamp_ntz")
    t.write(df)
    with pytest.raises(StoreError):
        t.write_partitions(df, ["m202401"])                 # the February row is outside
    assert t.current_version() == 1 and t.read().count() == 2


def test_sweep_with_empty_universe_keeps_old_version(spark):
    spec = TableSpec("t", ("id",), audit_col="changed", company_col="company", company_values=(1,))
    schema = "id long, company int, v string, changed timestamp_ntz"
    t = VersionedTable(spark, scratch_path(spark, "empty_universe"))
    ingest(spec, spark.createDataFrame([(1, 1, "a", TS(2024, 1, 1))], schema), t, "2024-01-10 00:00:00")
    with pytest.raises(M.MergeError):
        ingest(spec, spark.createDataFrame([], schema), t, "2024-01-10 00:00:00", sweep=True)
    assert t.current_version() == 1 and t.read().count() == 1


def test_late_writer_leaves_the_committed_version_alone(spark):
    t = VersionedTable(spark, scratch_path(spark, "late"))
    t.write(spark.createDataFrame([(0,)], "x int"))
    late = VersionedTable(spark, t.root)
    late.current_version = lambda: 1                     # it took its version number before the other one published
    t.write(spark.createDataFrame([(1,), (2,)], "x int"))
    with pytest.raises(StoreError):
        late.write(spark.createDataFrame([(99,)], "x int"))
    assert sorted(r.x for r in t.read().collect()) == [1, 2] and t.row_count() == 2


def test_partition_settings_come_from_the_manifest(spark):
    root = scratch_path(spark, "settings")
    df = spark.range(40).withColumn("v", F.col("id"))
    ingest(TableSpec("t", ("id",)), df, VersionedTable(spark, root, partition_col="id", buckets=8), "2024-01-09 00:00:00")
    with pytest.raises(StoreError):
        VersionedTable(spark, root, partition_col="id", buckets=64)
    with pytest.raises(StoreError):
        VersionedTable(spark, root, partition_col="v")
    t = VersionedTable(spark, root)
    assert (t.partition_col, t.buckets) == ("id", 8)
    ingest(TableSpec("t", ("id",)), df, t, "2024-01-10 00:00:00")
    assert t.read().count() == t.read().select("id").distinct().count() == 40


def test_row_that_moves_between_partitions(spark):
    spec = TableSpec("t", ("id",), audit_col="changed")
    schema = "id long, made timestamp_ntz, changed timestamp_ntz"
    t = VersionedTable(spark, scratch_path(spark, "moved"), partition_col="made")
    ingest(spec, spark.createDataFrame([(1, TS(2024, 1, 5), TS(2024, 1, 5)), (2, TS(2024, 3, 5), TS(2024, 3, 5))], schema), t, "2024-03-10 00:00:00")
    r = ingest(spec, spark.createDataFrame([(1, TS(2024, 2, 5), TS(2024, 3, 9))], schema), t, "2024-03-10 00:00:00")
    assert (r.inserted, r.updated, r.saved) == (0, 1, 2)
    assert sorted((x.id, x.made.month) for x in t.read().collect()) == [(1, 2), (2, 3)]


def test_vacuum_keeps_what_kept_versions_need(spark):
    t = VersionedTable(spark, scratch_path(spark, "vacuum"))
    for i in range(4):
        t.write(spark.createDataFrame([(i,)], "x int"))
    assert t.vacuum(keep=2) == []                        # all younger than the grace
    t.write(spark.createDataFrame([(4,)], "x int"))
    assert len(t.vacuum(keep=2, grace_hours=0)) == 3
    assert [r.x for r in t.read().collect()] == [4] and [r.x for r in t.read(version=4).collect()] == [3]
    assert t.manifest(2) is None


@pytest.mark.parametrize("partitioned", [False, True])
def test_merge_schema_drift_policy(spark, partitioned):
    from tierwise.sources.schema import SchemaDriftError
    spec = TableSpec("t", ("id",), audit_col="changed")
    t = VersionedTable(spark, scratch_path(spark, "drift"), partition_col="changed" if partitioned else None)
    ingest(spec, spark.createDataFrame([(1, "a", TS(2024, 1, 1))], "id long, v string, changed timestamp_ntz"),
           t, "2024-01-10 00:00:00")
    wider = spark.createDataFrame([(2, "b", "new", TS(2024, 1, 9))],
                                  "id long, v string, extra string, changed timestamp_ntz")
    with pytest.raises(SchemaDriftError):
        ingest(spec, wider, t, "2024-01-10 00:00:00")                     # default: fail
    assert t.current_version() == 1
    r = ingest(spec, wider, t, "2024-01-10 00:00:00", drift="add_nullable")
    got = sorted((x["id"], x["extra"]) for x in t.read().collect())
    assert got == [(1, None), (2, "new")] and r.inserted == 1


@pytest.mark.parametrize("partitioned", [False, True])
def test_pinned_version_reads(spark, partitioned):
    t = VersionedTable(spark, scratch_path(spark, "pinned"), partition_col="d" if partitioned else None)
    t.write(spark.createDataFrame([(1, TS(2024, 1, 5))], "k long, d timestamp_ntz"))
    t.write(spark.createDataFrame([(2, TS(2024, 1, 6)), (3, TS(2024, 2, 6))], "k long, d timestamp_ntz"))
    assert sorted(r.k for r in t.read().collect()) == [2, 3]
    assert [r.k for r in t.read(version=1).collect()] == [1]             # immutable, repeatable
    with pytest.raises(StoreError):
        VersionedTable(spark, t.root, partition_col="d").read(version=9)


def test_partitioned_sweep_rewrites_only_orphan_partitions(spark, sf_small):
    orders = spark.read.parquet(f"{sf_small}/orders.parquet")
    spec = TableSpec("orders", ("o_orderkey",), audit_col="o_orderdate")
    flat = VersionedTable(spark, scratch_path(spark, "sweep_flat"))
    part = VersionedTable(spark, scratch_path(spark, "sweep_part"), partition_col="o_orderdate")
    as_of = "2001-08-01 00:00:00"
    for t in (flat, part):
        ingest(spec, orders, t, as_of)
    before = part.manifest()["parts"]
    # the source lost the 1996 orders of status 'P'
    lost = (F.year("o_orderdate") == 1996) & (F.col("o_orderstatus") == "P")
    src = orders.where(~lost)
    r_flat = ingest(spec, src, flat, as_of, sweep=True)
    r_part = ingest(spec, src, part, as_of, sweep=True)
    assert r_part.strategy == "window_merge@partitions+sweep"
    assert (r_part.extracted, r_part.inserted, r_part.updated, r_part.removed, r_part.saved) == \
        (r_flat.extracted, r_flat.inserted, r_flat.updated, r_flat.removed, r_flat.saved)
    assert r_part.removed == orders.where(lost).count() > 0
    a, b = flat.read(), part.read()
    assert a.exceptAll(b.select(*a.columns)).isEmpty() and b.select(*a.columns).exceptAll(a).isEmpty()
    after = part.manifest()["parts"]
    rewritten = {k for k in after if after[k]["v"] == 2}
    assert all(k.startswith("m1996") or k >= "m200106" for k in rewritten)  # orphan months + window months
    assert all(after[k] == before[k] for k in after if k not in rewritten)
    with pytest.raises(M.MergeError):
        ingest(spec, orders.limit(0), part, as_of, sweep=True)             # empty universe refused
    assert part.current_version() == 2


def test_concurrent_writer_is_detected(spark):
    t = VersionedTable(spark, scratch_path(spark, "race"))
    t.write(spark.createDataFrame([(1,)], "x int"))
    other = VersionedTable(spark, t.root)

    def interleave():                      # another writer publishes meanwhile
        other.write(spark.createDataFrame([(2,)], "x int"))

    with pytest.raises(StoreError):
        t.write(spark.createDataFrame([(3,)], "x int"), before_publish=interleave)
    assert t.current_version() == 2 and [r.x for r in t.read().collect()] == [2]
