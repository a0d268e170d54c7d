"""What products and comparisons move: joins on the way of a fact's rows, reads of a
frame, and the rows that one task holds."""

import datetime as dt

from pyspark.sql import functions as F

from tierwise.operators import digests as D
from tierwise.operators import reconcile as R
from tierwise.plans.products import build_product

from .test_products import FakeBronze, P

TS = dt.datetime


def nodes(df):
    todo = [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        n = todo.pop()
        todo += [n.children().apply(i) for i in range(n.children().size())]
        yield n


def names(plan):
    return {plan.output().apply(i).name() for i in range(plan.output().size())}


def joins_that_move(df, column):
    return sum(n.nodeName() == "Join" and column in names(n.children().apply(0)) for n in nodes(df))


def test_report_items_are_moved_once_for_each_key_of_their_own(spark):
    day = TS(2024, 1, 10)
    item = dict(USU_CODEMP=1, USU_CODFIL=1, USU_CODFOR="5", USU_CODLAU="9", USU_SERMAC="M1", USU_CODPRO="A", USU_CODDER=None, USU_OBSCLI="x", USU_USUTEC="3")
    data = {"USU_TLAUITE": [item | dict(USU_NUMNFC=1), item | dict(USU_NUMNFC=1), item | dict(USU_NUMNFC=2), item | dict(USU_NUMNFC=3, USU_SERMAC=None)],
            "E440NFC": [dict(CODEMP=1, CODFIL=1, CODFOR="5", NUMNFC=n, DATENT=d) for n, d in ((1, day), (2, TS(2023, 1, 1)), (3, TS(2024, 1, 1)))],
            "E095FOR": [dict(CODFOR="5", NOMFOR="one"), dict(CODFOR="5", NOMFOR="two")],
            "E075PRO": [dict(CODEMP=1, CODPRO="A", CODORI="PRO")], "E075DER": [dict(CODEMP=1, CODPRO="A", CODDER=None, CODAGT="G")]}
    df = build_product("FAT_LAUDOS", FakeBronze(spark, data), P)
    got = sorted((str(r.USU_SERMAC), r.NOMFOR, r.CODORI, r.CODAGT) for r in df.collect())
    # the look-up of products holds with a missing variant, each repeated supplier counts, old notes are left out
    assert got == sorted([("M1", n, "PRO", None) for n in ("one", "one", "two", "two")] + [("None", n, "PRO", None) for n in ("one", "two")])
    assert joins_that_move(df, "USU_OBSCLI") <= 10


def test_performance_reads_its_entries_few_times(spark):
    entry = dict(CODEMP=1, CODORI="PRO", NUMORP=7, CODETG="1", SEQROT=1, DATREA=TS(2024, 2, 3), CODCRE="R", CODPRO="A", CODDER=" ", HORREA=1)
    data = {"E900EOQ": [entry | dict(CODOPR="X", QTDRE1=2, TMPBRU=3), entry | dict(CODOPR="Y", QTDRE1=5, TMPBRU=7), entry | dict(CODOPR=None, QTDRE1=1, TMPBRU=9)],
            "E900COP": [dict(CODEMP=1, CODORI="PRO", NUMORP=7, CODPRO="A", DTRINI=TS(2024, 1, 5))],
            "E630SPE": [dict(CODEMP=1, CODORI="PRO", NUMORP=7, CODPRO="A", CODETG="99", SDOATU=4)]}
    df = build_product("FAT_DESEMPENHO_PRODUCAO", FakeBronze(spark, data), P)
    (r,) = [x for x in df.collect() if x.TIPTAB == 1]
    # the quantity counts a missing operation, whose own time is unknown: (3 + 7) / 2
    assert (float(r.QTDREA), float(r.TMPBRU), float(r.QTDAND)) == (8.0, 5.0, 4.0)
    assert sum(n.children().size() == 0 and "DATREA" in names(n) for n in nodes(df)) <= 7


def test_billing_moves_return_lines_for_keys_of_their_own_only(spark):
    line = dict(CODEMP=1, CODFIL=1, CODFOR="5", CODSNF="S", SNFNFV="S", NUMNFC=1, NUMNFV=8, CODPRO="A", CODDER=" ", QTDREC=2, PREUNI=3, VLRLIQ=6, VECIPI=0, VLRICS=0, VLROUT=0, ICMVFC=1)
    data = {"E440IPC": [line | dict(TNSPRO="a", SEQIPC=1), line | dict(TNSPRO="b", SEQIPC=2), line | dict(TNSPRO=None, SEQIPC=3)],
            "E001TNS": [dict(CODEMP=1, CODTNS="a", CPRTCF="D", COMNAT="1202", VENFAT="S"), dict(CODEMP=1, CODTNS="b", CPRTCF="D", COMNAT="1603", VENFAT="S")],
            "E440NFC": [dict(CODEMP=1, CODFIL=1, CODFOR="5", CODSNF="S", NUMNFC=1, SITNFC="2", TIPNFE="2", DATENT=TS(2024, 2, 2))],
            "E095FOR": [dict(CODFOR="5", CODCLI=3)], "E085CLI": [dict(CODCLI=3, CODGRE="9", USU_CODRVR=6)], "E069GRE": [dict(CODGRE="9", CLIBAS=30)],
            "E085HCL": [dict(CODEMP=1, CODFIL=1, CODCLI=3, CODREP=4), dict(CODEMP=1, CODFIL=1, CODCLI=3, CODREP=5)], "E090REP": [dict(CODREP=4, USU_CODRVR=11)]}
    df = build_product("FAT_FATURAMENTO", FakeBronze(spark, data), P)
    # the nature of line b asks for another kind of entry; the customer's two histories both count
    assert sorted((r.SEQIPC, r.CODCLI, r.CODCLIBASE, r.CODREP, str(r.CODREGREP), r.CODREGCLI) for r in df.collect()) == \
        [(1, 3, 30, 4, "11", "6"), (1, 3, 30, 5, "None", "6")]
    assert joins_that_move(df, "VECIPI") <= 4


def test_tasks_follow_the_rows(spark, monkeypatch):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert R.tasks_for(spark, 0) == n and R.tasks_for(spark, (n + 3) * R.ROWS_A_TASK) == n + 3
    monkeypatch.setattr(R, "ROWS_A_TASK", 100)
    old, new = spark.range(1000).selectExpr("id k", "cast(null as double) x"), spark.range(1500).where("id % 7 <> 0").selectExpr("id k", "cast(null as double) x")
    diff = R.one_sided_diff(old.union(old), new)
    assert sorted(r.k for r in diff.collect()) == list(range(0, 1000, 7))
    assert "hashpartitioning(_row#" in (plan := diff._jdf.queryExecution().executedPlan().toString()) and ", 33)" in plan
    _, removed = D.range_sweep(old, new, ["k"])
    assert sorted(r.k for r in removed.collect()) == list(range(0, 1000, 7))
    assert ", 13)" in removed._jdf.queryExecution().executedPlan().toString()


def test_one_sided_diff_by_name_and_equal_values(spark):
    old = spark.createDataFrame([(1, 0.0), (1, -0.0), (2, float("nan")), (3, None), (None, 4.0), (5, 5.0), (5, 5.0)], "a int, x double")
    new = spark.createDataFrame([(-0.0, 1), (float("nan"), 2), (None, 3), (4.0, None), (1.0, 6)], "x double, a int")
    got = R.one_sided_diff(old, new)
    assert got.columns == ["a", "x"] and [tuple(r) for r in got.collect()] == [(5, 5.0)]
    assert R.one_sided_diff(old, old.where(F.lit(False))).count() == 5
