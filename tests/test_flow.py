"""Bronze -> silver through storage: catalog spec, ingest, product, upsert load."""

import datetime as dt

from tierwise.operators.ingest import ingest
from tierwise.plans.bronze_schemas import BRONZE_SCHEMAS
from tierwise.plans.products import ProductParams, TableBronze, build_product, load_product
from tierwise.session import scratch_path
from tierwise.sources.bronze_catalog import bronze_catalog
from tierwise.sources.store import VersionedTable

TS = dt.datetime


def test_catalog_matches_the_source_registry():
    cat = bronze_catalog()
    cat.check_size(69)
    assert len(cat.distinct_tables()) == 67
    assert set(cat.multi_writer) == {"E044CCU", "R910USU"}
    assert set(cat.multi_writer) <= set(BRONZE_SCHEMAS) and cat.distinct_tables() == set(BRONZE_SCHEMAS)
    from tierwise.sources.bronze_catalog import default_partition_cols
    parts = default_partition_cols()
    assert parts["E140IPV"] == "DATGER" and parts["USU_T101MET"] == "USU_DATGER" and "E085CLI" not in parts
    cpg = cat.get("E028CPG")
    assert (cpg.audit_col, cpg.fallback_col, cpg.company_col) == ("DATATU", "DATGER", "CODEMP")
    assert cat.get("E900EOQ").sentinel == "1900-12-31"
    assert cat.get("USU_VZRASLAU").keyless and cat.get("USU_T650ORC", "opex").company_values == (1, 50)


def _source(spark, rows):
    cols = [c.split()[0] for c in BRONZE_SCHEMAS["E028CPG"].split(", ")]
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], BRONZE_SCHEMAS["E028CPG"])


def test_bronze_to_silver_two_cycles(spark):
    spec = bronze_catalog().get("E028CPG")
    root = scratch_path(spark, "bronze")
    bronze_t = VersionedTable(spark, f"{root}/E028CPG")
    silver_t = VersionedTable(spark, scratch_path(spark, "silver_cpg"))
    day1, day2 = "2024-03-01 00:00:00", "2024-03-02 00:00:00"
    old = dict(CODEMP=1, CODCPG="030", DESCPG="a vista", PRZMED=0, SITCPG="A", DATGER=TS(2023, 1, 1),
               DATATU=TS(2023, 1, 1))
    other = dict(CODEMP=2, CODCPG="999", DESCPG="other company", SITCPG="A", DATGER=TS(2024, 2, 1))
    r1 = ingest(spec, _source(spark, [old, other]), bronze_t, day1)
    assert (r1.strategy, r1.saved) == ("first_load", 1)                 # scope: company 1 only
    p = ProductParams(as_of=day1)
    load_product("DIM_CONDICAO_PAGAMENTO", build_product("DIM_CONDICAO_PAGAMENTO", TableBronze(spark, root), p),
                 silver_t, day1)
    edited = dict(old, DESCPG="a vista 2", DATATU=TS(2024, 2, 20))
    new_no_audit = dict(CODEMP=1, CODCPG="060", DESCPG="sixty", PRZMED=60, SITCPG="I",
                        DATGER=TS(2024, 2, 25), DATATU=None)             # found through the fallback column
    r2 = ingest(spec, _source(spark, [edited, new_no_audit, other]), bronze_t, day2)
    assert (r2.extracted, r2.inserted, r2.updated, r2.saved) == (2, 1, 1, 2)
    n = load_product("DIM_CONDICAO_PAGAMENTO",
                     build_product("DIM_CONDICAO_PAGAMENTO", TableBronze(spark, root), ProductParams(as_of=day2)),
                     silver_t, day2)
    got = {r.CODCPG: (r.DESCPGTO, r.SITCPG_DESC) for r in silver_t.read().collect()}
    assert n == 2 and got == {"030": ("0 PM - A VISTA 2", "ATIVA"), "060": ("60 PM - SIXTY", "INATIVA")}
    assert {r.DW_DATA_PROCESSAMENTO for r in silver_t.read().collect()} == {TS(2024, 3, 2)}
    assert silver_t.loaded_as_of() == day2


def test_refresh_area_isolates_failures(spark):
    from pyspark.sql import functions as F

    from tierwise.operators.ingest import refresh_area, run_summary
    cat = bronze_catalog()
    root = scratch_path(spark, "area")

    def read_source(spec):
        if spec.name == "R910USU":
            raise IOError("source unavailable")
        return spark.createDataFrame([], BRONZE_SCHEMAS[spec.name]) if spec.name != "E028CPG" else \
            _source(spark, [dict(CODEMP=1, CODCPG="1", DATGER=TS(2024, 1, 1))])

    m = refresh_area(spark, cat, "opex", read_source, root, "2024-03-01 00:00:00", parallelism=3)
    got = {r.table_name: r.status for r in m.collect()}
    assert len(got) == len([s for s in cat.specs.values() if s.owner == "opex"])
    assert got["R910USU"].startswith("ERROR") and got["USU_T650ORC"] == "EMPTY_BATCH_KEPT_OLD"
    assert run_summary(m).where(F.col("status").startswith("ERROR")).first()["n_tables"] == 1


def test_stale_edit_needs_snapshot_merge_and_is_caught_by_content_diff(spark):
    """An edit that does not touch the audit column escapes the look-back
    window; re-reading everything (no trusted audit column) fixes it, and only
    the content check (REC-05) reveals it."""
    from dataclasses import replace

    from tierwise.operators import reconcile as R
    spec = bronze_catalog().get("E028CPG")
    t = VersionedTable(spark, scratch_path(spark, "stale"))
    row = dict(CODEMP=1, CODCPG="1", DESCPG="old", DATGER=TS(2023, 1, 1), DATATU=TS(2023, 1, 1))
    ingest(spec, _source(spark, [row]), t, "2024-03-01 00:00:00")
    edited = _source(spark, [dict(row, DESCPG="new")])                   # audit column not updated
    r = ingest(spec, edited, t, "2024-03-02 00:00:00")
    assert r.extracted == 0 and t.read().first()["DESCPG"] == "old"      # stale row survives the window
    cols = [c for c in edited.columns]
    assert R.symmetric_diff(edited, t.read(), cols).count() == 2          # content check catches it
    ingest(replace(spec, audit_col=None, fallback_col=None), edited, t, "2024-03-02 00:00:00")
    assert t.read().first()["DESCPG"] == "new"
    assert R.symmetric_diff(edited, t.read(), cols).count() == 0


def test_run_products_cycle(spark):
    from tierwise.plans.products import run_products
    root = scratch_path(spark, "bronze_cycle")
    spec = bronze_catalog().get("E028CPG")
    ingest(spec, _source(spark, [dict(CODEMP=1, CODCPG="1", DESCPG="x", DATGER=TS(2024, 1, 1))]),
           VersionedTable(spark, f"{root}/E028CPG"), "2024-03-01 00:00:00")
    m = run_products(spark, ["DIM_CONDICAO_PAGAMENTO", "DIM_PRODUTO"], TableBronze(spark, root),
                     scratch_path(spark, "silver_cycle"), ProductParams(as_of="2024-03-01 00:00:00"),
                     parallelism=2)
    got = {r["product"]: (r["status"], r["saved"]) for r in m.collect()}
    assert got["DIM_CONDICAO_PAGAMENTO"] == ("OK", 1)
    assert got["DIM_PRODUTO"][0].startswith("ERROR")            # its bronze tables are absent


def test_run_products_skips_stale_inputs(spark):
    from tierwise.plans.products import run_products
    root = scratch_path(spark, "bronze_fresh")
    spec = bronze_catalog().get("E028CPG")
    t = VersionedTable(spark, f"{root}/E028CPG")
    ingest(spec, _source(spark, [dict(CODEMP=1, CODCPG="1", DESCPG="x", DATGER=TS(2024, 1, 1))]), t,
           "2024-03-01 08:00:00")
    assert t.loaded_as_of() == "2024-03-01 08:00:00"
    silver = scratch_path(spark, "silver_fresh")
    p = ProductParams(as_of="2024-03-01 10:00:00")
    m = run_products(spark, ["DIM_CONDICAO_PAGAMENTO"], TableBronze(spark, root), silver, p,
                     fresh_after="2024-03-01 09:00:00")
    assert m.first()["status"] == "STALE_INPUT: E028CPG"
    m = run_products(spark, ["DIM_CONDICAO_PAGAMENTO"], TableBronze(spark, root), silver, p,
                     fresh_after="2024-03-01 07:00:00")
    assert m.first()["status"] == "OK"
