"""Rows that a join will drop are left out before they move."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tierwise.operators import heavy_keys as HK
from tierwise.operators.membership import keep_members
from tierwise.plans.products import build_product

from .test_products import FakeBronze, P

TS = dt.datetime


def rows_moved(df, column):
    """Rows that the shuffles of ``column`` wrote when ``df`` ran."""
    todo, n = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        p = todo.pop()
        name = p.nodeName()
        todo += [p.executedPlan()] if name == "AdaptiveSparkPlan" else [p.plan()] if name.endswith("QueryStage") else [p.children().apply(i) for i in range(p.children().size())]
        if name == "Exchange" and column in {p.output().apply(i).name() for i in range(p.output().size())}:
            n += p.metrics().apply("shuffleRecordsWritten").value()
    return n


def test_members_stay(spark):
    a = spark.createDataFrame([(i % 700 if i % 11 else None, f"k{i % 13}", TS(2024, 1, 1 + i % 20), i) for i in range(4000)], "x long, y string, z timestamp_ntz, n int")
    b = spark.createDataFrame([(i if i % 5 else None, f"k{i % 13}", TS(2024, 1, 1 + i % 20)) for i in range(0, 700, 9)] * 3, "p long, q string, r timestamp_ntz")
    for expected in (None, 1, 10**9):
        got = keep_members(a, ["x", "y", "z"], b, ["p", "q", "r"], expected)
        join = lambda df: sorted(r["n"] for r in df.join(b.distinct(), (F.col("x") == F.col("p")) & (F.col("y") == F.col("q")) & (F.col("z") == F.col("r"))).collect())
        assert join(got) == join(a) != [] and got.columns == a.columns
        if expected != 1:
            assert len(join(a)) <= got.count() <= len(join(a)) + 150
    assert keep_members(a, ["x"], b.limit(0), ["p"]).count() == 0
    # types without one hash for equal values are not tested: the join decides
    assert keep_members(a, ["x"], b.selectExpr("double(p) AS p"), ["p"]).count() == 4000
    assert keep_members(a, ["x", "y"], b.selectExpr("int(p) AS x", "q AS y")).where("y = 'k3'").count() == a.where("y = 'k3'").count()


@pytest.mark.parametrize("bypass", [True, False])
def test_rows_without_a_key_are_dealt(spark, bypass):
    a = spark.createDataFrame([(None if i % 3 else "h" if i % 2 else f"s{i}", i) for i in range(600)], "k string, n int").repartition(3)
    b = spark.createDataFrame([("h", 1), ("h", 2), ("s6", 3), (None, 4)], "k string, v int")
    want = sorted(map(str, a.join(b, ["k"], "left").collect()))
    assert sorted(map(str, HK.heavy_left_join(a, b, ["k"], shares=20, salts=8, bypass=bypass).collect())) == want
    assert sorted(map(str, HK.heavy_left_join(a, b.limit(0), ["k"], empty=("h",), shares=20, salts=8, bypass=bypass).collect())) == sorted(map(str, a.selectExpr("k", "n", "int(null) AS v").collect()))


def test_report_items_without_entry_do_not_move(spark):
    item = dict(USU_CODEMP=1, USU_CODFIL=1, USU_CODFOR="5", USU_CODDER=" ", USU_OBSCLI="x", USU_USUTEC="3")
    items = [item | dict(USU_NUMNFC=i, USU_CODLAU=f"L{i}", USU_CODPRO=f"P{i}", USU_SERMAC=None if i % 7 == 0 else " " if i % 5 == 0 else f"M{i // 2}") for i in range(900)]
    data = {"USU_TLAUITE": items + items[:10],
            "E440NFC": [dict(CODEMP=1, CODFIL=1, CODFOR="5", NUMNFC=i, DATENT=TS(2024, 1, 1 + i % 3) if i < 30 else TS(2020, 1, 1)) for i in range(0, 900)],
            "USU_TLAUGER": [dict(USU_CODEMP=1, USU_CODFIL=1, USU_CODLAU=f"L{i}", USU_CODSIT="3", USU_NUMNFV=i, USU_DATSEP=TS(2024, 2, 1)) for i in range(900)],
            "E140NFV": [dict(CODEMP=1, CODFIL=1, NUMNFV=i, CODTRA="T", USU_CODRAS=f"R{i}") for i in range(900)],
            "USU_VZRASLAU": [dict(USU_CODBAR=" " if i == 0 else f"M{i}", EMPNFV=1, FILNFV=1, NUMOCP=i, NOMFOR=f"F{i}") for i in range(900)]}
    df = build_product("FAT_LAUDOS", FakeBronze(spark, data), P)
    got = df.collect()
    assert len(got) == 40 and all(r.USU_CODRAS == f"R{r.USU_CODLAU[1:]}" for r in got)
    assert {(r.USU_SERMAC, r.NUMOCP) for r in got} == {(s, None if s is None else 0 if s == " " else int(s[1:]) or None) for s in {i["USU_SERMAC"] for i in items[:30]}}
    assert rows_moved(df, "USU_OBSCLI") < 500 and rows_moved(df, "USU_CODRAS") < 500


def test_performance_moves_rows_of_its_orders(spark):
    orders, late = range(400), set(range(0, 400, 40))
    data = {"E900EOQ": [dict(CODEMP=1, CODORI="PRO", NUMORP=i, CODETG=str(1 + k % 2), SEQROT=None if k == 3 else k, DATREA=TS(2024, 2, 3) if i in late else TS(2023, 7, 3), CODCRE="R", CODPRO="A", CODDER=" ", HORREA=1,
                              CODOPR=f"X{k % 2}", QTDRE1=2, TMPBRU=3) for i in orders for k in range(4)],
            "E900COP": [dict(CODEMP=1, CODORI="PRO", NUMORP=i, CODPRO="A", DTRINI=TS(2024, 1, 5) if i in late else TS(2015, 1, 5), DTRFIM=TS(2024, 2, 9), SITORP="E") for i in orders],
            "E900OOP": [dict(CODEMP=1, CODORI="PRO", NUMORP=i, CODETG=str(1 + k % 2), SEQROT=k, CODOPR="P", SFXETR="1", SFXSEQ="1", TMPPRP=60, UNICRE="M") for i in orders for k in range(3)],
            "E900QDO": [dict(CODEMP=1, CODORI="PRO", NUMORP=i, CODPRO="A", CODDER=" ", QTDPRV=4, QTDRFG=1) for i in orders],
            "E630SPE": [dict(CODEMP=1, CODORI="PRO", NUMORP=i, CODPRO="A", CODETG="99", SDOATU=5) for i in orders],
            "E093ETG": [dict(CODEMP=1, CODETG=str(k), CODCCU="C") for k in (1, 2)], "E725CRE": [dict(CODEMP=1, CODCRE="R", CODCCU=" ")],
            "E621MTC": [dict(CODEMP=1, NUMMTC=7, TIPMTC="28", DATINI=TS(2024, 1, 1), DATFIM=TS(2024, 12, 1))], "E626TAX": [dict(CODEMP=1, NUMMTC=7, CODCCU="C", TAXCUS=8)],
            "E210MVP": [dict(CODEMP=1, NUMDOC=i, ORIORP="PRO", CODETG="1", DATMOV=TS(2024, 2, 3), CODTNS="90251", CODPRO="B", ESTEOS="S", QTDMOV=2, VLRMOV=3) for i in orders if i in late or i == 1]}
    df = build_product("FAT_DESEMPENHO_PRODUCAO", FakeBronze(spark, data), P)
    got = df.collect()
    # steps 0 and 2 of a stage are one row; an entry without a step has no operation, and so no rate
    one = {(r.NUMORP, r.CODETG, r.CODOPR): (float(r.TAXREA), r.QTDREA and float(r.QTDREA), float(r.QTDPRV), r.QTDAND and float(r.QTDAND)) for r in got if r.TIPTAB == 1}
    assert one == {(i, *k): v for i in late for k, v in {("1", "P"): (8.0, 2.0, 8.0, 0.0), ("2", "P"): (8.0, 2.0, 4.0, 0.0), ("2", None): (0.0, None, 4.0, 0.0)}.items()}
    # the consumption of order 1 finds only an entry of another day
    assert {(r.NUMORP, r.DATREA, r.CODPRO, r.QTDTOP and float(r.QTDTOP)) for r in got if r.TIPTAB == 2} == \
        {(i, TS(2024, 2, 3), "A", 2.0) for i in late} | {(1, TS(2023, 7, 3), "A", None)}
    assert rows_moved(df, "DATREA") < 1600 and rows_moved(df, "TMPPRP") < 1200
