"""The command-line jobs: bronze refresh, count check, silver build (OPEX area)."""

import datetime as dt

from tierwise.__main__ import main
from tierwise.plans.bronze_schemas import BRONZE_SCHEMAS
from tierwise.session import scratch_path
from tierwise.sources.store import VersionedTable

TS = dt.datetime


def _write(spark, root, name, rows):
    cols = [c.split()[0] for c in BRONZE_SCHEMAS[name].split(", ")]
    spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], BRONZE_SCHEMAS[name]) \
        .write.parquet(f"{root}/{name}")


def test_cli_bronze_check_silver(spark):
    from decimal import Decimal
    src, brz, slv = (scratch_path(spark, n) for n in ("cli_src", "cli_bronze", "cli_silver"))
    k = dict(USU_CODEMP=1, USU_MESANO=TS(2024, 2, 1), USU_CODMPC="801", USU_CTADRE="A", USU_CODCCU="C",
             USU_DATALT=TS(2024, 2, 20))
    _write(spark, src, "USU_T650ORC", [dict(k, USU_ORCMES=Decimal(100)), dict(k, USU_CODEMP=7)])
    _write(spark, src, "USU_T650CUS", [dict(k, USU_CTAEMP="x", USU_SALMES=Decimal(40))])
    _write(spark, src, "E044CCU", [dict(CODEMP=1, CODCCU="C", DESCCU="plant", TIPCCU=1)])
    _write(spark, src, "R910USU", [dict(CODENT="o1", NOMCOM="Owner", DATALT=TS(2024, 1, 1))])
    _write(spark, src, "E043PCM", [dict(CODMPC="801", CTARED="A", DESCTA="rent", DATGER=TS(2024, 1, 1))])
    as_of = "2024-03-01 00:00:00"
    assert main(["bronze", "--area", "opex", "--source", src, "--bronze", brz, "--as-of", as_of, "--partitioned"]) == 0
    assert VersionedTable(spark, f"{brz}/USU_T650ORC").read().count() == 1      # company 7 out of scope
    assert main(["check", "--area", "opex", "--source", src, "--bronze", brz, "--content"]) == 0
    # an edit the look-back window would miss: counts still agree, content does not
    src2 = scratch_path(spark, "cli_src_edited")
    for t in ("USU_T650ORC", "USU_T650CUS", "E044CCU", "R910USU"):
        spark.read.parquet(f"{src}/{t}").write.parquet(f"{src2}/{t}")
    _write(spark, src2, "E043PCM", [dict(CODMPC="801", CTARED="A", DESCTA="rent (edited)", DATGER=TS(2024, 1, 1))])
    assert main(["check", "--area", "opex", "--source", src2, "--bronze", brz]) == 0
    assert main(["check", "--area", "opex", "--source", src2, "--bronze", brz, "--content"]) == 1
    assert main(["silver", "--bronze", brz, "--silver", slv, "--as-of", as_of,
                 "--product", "FAT_ORCAMENTO_OPEX"]) == 0
    r = VersionedTable(spark, f"{slv}/FAT_ORCAMENTO_OPEX").read().first()
    assert (r.ORCADO, r.REALIZADO, r.PROD, r.DESPESA) == (Decimal("100"), Decimal("40"), "Produtivo", "rent")


def test_cli_diff(spark):
    a, b = scratch_path(spark, "diff_a"), scratch_path(spark, "diff_b")
    spark.createDataFrame([(1, "x", TS(2024, 1, 1)), (2, "y", TS(2024, 1, 2))], "k long, v string, DW_DATA_PROCESSAMENTO timestamp_ntz").write.parquet(a)
    spark.createDataFrame([(1, "x", 9), (2, "z", 9)], "k long, v string, extra int").write.parquet(b)
    assert main(["diff", "--a", a, "--b", b, "--ignore", "DW_DATA_PROCESSAMENTO"]) == 1      # k=2 differs
    assert main(["diff", "--a", a, "--b", b, "--where", "k = 1"]) == 0


def test_cli_diff_pinned_versions(spark):
    t = VersionedTable(spark, scratch_path(spark, "diff_versions"))
    t.write(spark.createDataFrame([(1, "x")], "k long, v string"))
    t.write(spark.createDataFrame([(1, "y")], "k long, v string"))
    assert main(["diff", "--a", f"{t.root}@1", "--b", f"{t.root}@2"]) == 1
    assert main(["diff", "--a", f"{t.root}@2", "--b", t.root]) == 0
