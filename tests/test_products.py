"""The 21 data products on small synthetic bronze frames (FIXTURES.md §2-4)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

from tierwise.plans.bronze_schemas import BRONZE_SCHEMAS
from tierwise.plans.products import PRODUCTS, ProductParams, build_product, load_product
from tierwise.session import scratch_path
from tierwise.sources.store import VersionedTable

TS = dt.datetime
D = dt.date
P = ProductParams(as_of="2024-03-01 00:00:00", billing_cutoff="2024-01-01", production_cutoff="2024-01-01",
                  consumption_reach="2023-06-01", performance_floor="2023-01-01", reports_cutoff="2024-01-01",
                  trace_cutoff="2024-01-01")


class FakeBronze:
    def __init__(self, spark, data):
        self.spark, self.data = spark, data

    def __call__(self, name):
        schema = self.spark.createDataFrame([], BRONZE_SCHEMAS[name]).schema
        rows = []
        for d in self.data.get(name, []):
            unknown = set(d) - set(schema.fieldNames())
            assert not unknown, f"{name}: {unknown}"
            row = []
            for f in schema.fields:
                v = d.get(f.name)
                if v is not None and isinstance(f.dataType, T.DecimalType):
                    v = Decimal(str(v))
                row.append(v)
            rows.append(tuple(row))
        return self.spark.createDataFrame(rows, schema)


def one(df, **match):
    rows = [r for r in df.collect() if all(r[k] == v for k, v in match.items())]
    assert len(rows) == 1, rows
    return rows[0]


def test_registry_covers_21_products():
    assert len(PRODUCTS) == 21
    assert sum(s.kind == "dimension" for s in PRODUCTS.values()) == 11


def test_payment_terms(spark):
    b = FakeBronze(spark, {"E028CPG": [
        dict(CODEMP=1, CODCPG="030", DESCPG=" a vista ", PRZMED=30, ABRCPG="AV", QTDPAR=1, SITCPG="A",
             DATGER=TS(2024, 1, 5), DATATU=None),
        dict(CODEMP=2, CODCPG="999", DESCPG="x", SITCPG="I")]})
    df = build_product("DIM_CONDICAO_PAGAMENTO", b, P)
    r = one(df)
    assert (r.DESCPG, r.DESCPGTO, r.SITCPG_DESC, r.DATCAD, r.ULTATU) == \
        ("A VISTA", "30 PM - A VISTA", "ATIVA", "05/01/2024", None)


def test_product_variants_item_key(spark):
    b = FakeBronze(spark, {
        "E075DER": [dict(CODEMP=1, CODPRO="P1", CODDER=" ", CODAGT="G", SITDER="A"),
                    dict(CODEMP=1, CODPRO="P1", CODDER="V1", CODAGT="G", SITDER="I")],
        "E075PRO": [dict(CODEMP=1, CODPRO="P1", DESPRO=" bolt ", PERIPI=10, CODCLF="C1")],
        "E013AGP": [dict(CODEMP=1, CODAGP="G", DESAGP=" Group ")],
        "E022CLF": [dict(CODCLF="C1", CLAFIS="8471", CODCES="1")]})
    df = build_product("DIM_PRODUTO", b, P)
    assert sorted(r.CHAVE_ITEM for r in df.collect()) == ["P1", "P1-V1"]
    r = one(df, CHAVE_ITEM="P1")
    assert (r.DESCITEM, r.PERIPI, r.CATEGORIA, r.CODNCM, r.SITITEM) == ("BOLT", Decimal("0.1"), "Group", "8471", "ATIVO")


def test_sales_reps(spark):
    b = FakeBronze(spark, {"E090REP": [
        dict(CODREP=7, CGCCPF="123", TIPREP="F", NOMREP=" ana ", USU_TIPREP="2", SITWMW="A",
             FONREP="(11) 99-88", USU_CODRAM="r1", USU_CODRVR=3, DATCAD=TS(2020, 5, 1, 13)),
        dict(CODREP=8, CGCCPF="123", TIPREP="J", FONREP="--", USU_TIPREP="9")],
        "E026RAM": [dict(CODRAM="r1", DESRAM="retail")],
        "USU_T017RVR": [dict(USU_CODRVR=3, USU_NOMRVR="north")]})
    df = build_product("DIM_REPRESENTANTE", b, P)
    a, z = one(df, CODREP=7), one(df, CODREP=8)
    assert (a.DOCREP, a.TIPOREP, a.TELEFONE, a.RAMO, a.NOME_REGIONAL, a.DT_CADASTRO) == \
        ("00000000123", "RCA", "119988", "RETAIL", "NORTH", D(2020, 5, 1))
    assert (z.DOCREP, z.TIPOREP, z.TELEFONE, z.SITREP) == ("00000000000123", "OUTROS", None, "INATIVO")


def test_regions_override_priority(spark):
    b = FakeBronze(spark, {
        "USU_T017RVR": [dict(USU_CODRVR=5, USU_NOMRVR="Sul", USU_USUCOR="u1", USU_USUASS="u9"),
                        dict(USU_CODRVR=6, USU_NOMRVR="Norte", USU_USUCOR="u2"),
                        dict(USU_CODRVR=7, USU_NOMRVR="Leste", USU_USUCOR="u3")],
        "R999USU": [dict(CODUSU="u1", NOMUSU="maria.silva"), dict(CODUSU="u2", NOMUSU="joao.souza"),
                    dict(CODUSU="u3", NOMUSU="pedro.lima")]})
    by_region = spark.createDataFrame([(5, "OWNER FIVE")], "ID_REGIONAL long, RESPONSAVEL string")
    by_login = spark.createDataFrame([("joao.souza", "OWNER LOGIN")], "LOGIN string, RESPONSAVEL string")
    df = build_product("DIM_REGIONAL", b, P, by_region=by_region, by_login=by_login)
    r5, r6, r7 = one(df, ID_REGIONAL=5), one(df, ID_REGIONAL=6), one(df, ID_REGIONAL=7)
    assert (r5.RESPONSAVEL, r5.NOME_REGIONAL, r5.ASSISTENTE) == ("OWNER FIVE", "R05 - SUL", "NÃO IDENTIFICADO")
    assert r6.RESPONSAVEL == "OWNER LOGIN" and r7.RESPONSAVEL == "PEDRO LIMA"


def test_targets_decodes(spark):
    b = FakeBronze(spark, {
        "USU_T101MET": [dict(USU_CODEMP=1, USU_MESANO=TS(2024, 1, 1), USU_CODTIP="T", USU_SEQREG=1,
                             USU_CODCRI="C", USU_CODREP=7, USU_VLRMET=100, USU_NOMUSU=" bob ")],
        "USU_T101CRI": [dict(USU_CODCRI="C", USU_DESCRI="vol", USU_UNICRI=2, USU_DIRCRI=3)],
        "E090REP": [dict(CODREP=7, NOMREP="ana")]})
    r = one(build_product("FAT_METAS", b, P))
    assert (r.DESC_UNICRI, r.DESC_DIRCRI, r.NOME_REP, r.USUARIO, r.DESC_TIPO) == \
        ("VALOR", "NÃO DEFINIDO", "ANA", "BOB", None)


def _customer_bronze(spark):
    note = lambda n, cli, day, rep: dict(CODEMP=1, CODFIL=1, NUMNFV=n, CODCLI=cli, DATEMI=day, CODREP=rep,  # noqa
                                         TIPNFS=1, SITNFV="2", TNSPRO="V")
    return FakeBronze(spark, {
        "E140NFV": [note(1, 10, TS(2024, 1, 1, 9), 100), note(2, 11, TS(2024, 1, 1, 15), 200),
                    note(3, 10, TS(2024, 1, 5), 300), note(4, 11, TS(2024, 2, 1), 400),
                    note(5, 10, TS(2024, 3, 1), 500), note(6, 10, TS(2024, 4, 1), 600)],
        "E001TNS": [dict(CODEMP=1, CODTNS="V", VENFAT="S")],
        "E140IDE": [dict(CODEMP=1, CODFIL=1, NUMNFV=n, SITDOE=3) for n in range(1, 7)],
        "E085CLI": [dict(CODCLI=10, CODGRE="G1", NOMCLI="base co", TIPCLI="J", CGCCPF="1", ENDCLI="rua a",
                         NENCLI="1", CPLEND="sala 2", BAICLI="centro", CIDCLI="x", SIGUFS="SP", CEPCLI="123"),
                    dict(CODCLI=11, CODGRE="G1", NOMCLI="branch", TIPCLI="F", CGCCPF="2", SITCLI="A")],
        "E069GRE": [dict(CODGRE="G1", NOMGRE="grp", CLIBAS=10)],
        "E090REP": [dict(CODREP=100, NOMREP="first"), dict(CODREP=600, NOMREP="last")],
    })


def test_customers_group_purchase_days_and_reps(spark):
    df = build_product("DIM_CLIENTE", _customer_bronze(spark), P)
    r = one(df, COD_CLIENTE=11)
    assert r.CODCLI_BASE == 10 and r.NOME_BASE == "BASE CO" and r.DOC_BASE == "00000000000001"
    # two notes on 2024-01-01 share the first purchase day (dense rank by day)
    assert (r.DT_PRIMCOMPRA_BASE, r.DT_SEGCOMPRA_BASE, r.DT_TERCOMPRA_BASE, r.DT_QUACOMPRA_BASE,
            r.DT_ULTCOMPRA_BASE) == (D(2024, 1, 1), D(2024, 1, 5), D(2024, 2, 1), D(2024, 3, 1), D(2024, 4, 1))
    assert (r.CODREP_ABERTURA, r.REP_ABERTURA, r.CODREP_ULTVENDA, r.REP_ULT_VENDA) == (100, "FIRST", 600, "LAST")
    base = one(df, COD_CLIENTE=10)
    assert base.ENDERECO_COMPLETO == "RUA A, 1 - CENTRO, X, SP, 00000123"     # complement never appended (T1)
    assert base.TIPO_CLIENTE == "PJ" and r.TIPO_CLIENTE == "PF" and r.NOME_GRUPO == "GRP"
    fixed = build_product("DIM_CLIENTE", _customer_bronze(spark),
                          ProductParams(faithful_address=False))
    assert one(fixed, COD_CLIENTE=10).ENDERECO_COMPLETO == "RUA A, 1 (SALA 2) - CENTRO, X, SP, 00000123"


def test_billing_four_blocks_and_fee_share(spark):
    b = FakeBronze(spark, {
        "E120IPD": [dict(CODEMP=1, CODFIL=1, NUMPED=1, SEQIPD=1, CODPRO="P", CODDER=" ", TNSPRO="90100",
                         QTDABE=2, PREUNI=10, VLRLIQ=20, VLRIPI=1, VLRICS=1, VSTFCP=1, VLROUT=1)],
        "E120PED": [dict(CODEMP=1, CODFIL=1, NUMPED=1, SITPED="1", DATPRV=TS(2024, 2, 1, 10), CODCLI=5)],
        "E140IPV": [dict(CODEMP=1, CODFIL=1, CODSNF="S", NUMNFV=9, SEQIPV=1, CODPRO="P", CODDER="V", TNSPRO="T",
                         QTDFAT=1, PREUNI=5, VLRLIQ=5, VLRIPI=0, VLRICS=0, VLROUT=0, DATGER=TS(2024, 2, 2))],
        "E140ISV": [dict(CODEMP=1, CODFIL=1, CODSNF="S", NUMNFV=9, SEQISV=1, CODSER="SV", TNSSER="T",
                         QTDFAT=1, PREUNI=3, VLRLIQ=3, DATGER=TS(2024, 2, 2))],
        "E140IDE": [dict(CODEMP=1, CODFIL=1, CODSNF="S", NUMNFV=9, SITDOE=3)],
        "E140NFV": [dict(CODEMP=1, CODFIL=1, CODSNF="S", NUMNFV=9, TIPNFS=1, SITNFV="2", CODCLI=5)],
        "E140PVD": [dict(CODEMP=1, CODFIL=1, CODSNF="S", NUMNFV=9, SEQIPV=1, VSTFCP=2)],
        "E001TNS": [dict(CODEMP=1, CODTNS="T", VENFAT="S"), dict(CODEMP=1, CODTNS="R", CPRTCF="D", COMNAT="1202")],
        "E440IPC": [dict(CODEMP=1, CODFIL=1, CODFOR="F", CODSNF="X", NUMNFC=3, SNFNFV="X", SEQIPC=s, CODPRO="P",
                         CODDER=" ", TNSPRO="R", QTDREC=1, PREUNI=4, VLRLIQ=4, VECIPI=0, VLRICS=0, VLROUT=0,
                         ICMVFC=0) for s in (1, 2)],
        "E440NFC": [dict(CODEMP=1, CODFIL=1, CODFOR="F", CODSNF="X", NUMNFC=3, SITNFC="2", TIPNFE="2",
                         DATENT=TS(2024, 2, 3), VSTFCP=10)],
        "E095FOR": [dict(CODFOR="F", CODCLI=5)],
    })
    df = build_product("FAT_FATURAMENTO", b, P)
    got = {r.TIPOREG: r for r in df.collect()}
    assert set(got) == {"PED", "VENPRO", "VENSER", "DEV"} or len(df.collect()) == 5
    assert got["PED"].CHAVE_ITEM == "P-" and got["PED"].VLR_SLI == Decimal("16") and got["PED"].DATAREF == D(2024, 2, 1)
    assert got["VENPRO"].CHAVE_ITEM == "P-V" and got["VENPRO"].VLR_FUNDPOB == Decimal("2")
    assert got["VENSER"].CODDEP is None and got["VENSER"].VLR_FUNDPOB == Decimal("0")
    dev = [r for r in df.collect() if r.TIPOREG == "DEV"]
    assert len(dev) == 2 and all(r.VLR_FUNDPOB == Decimal("-5") for r in dev)     # 10 / 2 lines, negated
    assert all(r.QTDITEM == Decimal("-1") and r.CHAVE_ITEM == "P-1" for r in dev)


def test_opex_budget_full_join_filter(spark):
    k = dict(USU_CODEMP=1, USU_MESANO=TS(2024, 5, 1), USU_CODMPC="801", USU_CTADRE="A", USU_CODCCU="C")
    b = FakeBronze(spark, {
        "USU_T650ORC": [dict(k, USU_ORCMES=100), dict(k, USU_CODMPC="900", USU_ORCMES=1)],
        "USU_T650CUS": [dict(k, USU_CTAEMP="x", USU_SALMES=30), dict(k, USU_CTAEMP="y", USU_SALMES=20),
                        dict(k, USU_CTADRE="ONLY-ACTUAL", USU_SALMES=5)],
        "E044CCU": [dict(CODEMP=1, CODCCU="C", DESCCU="plant", TIPCCU=2, USU_CODRES="o1")],
        "R910USU": [dict(CODENT="o1", NOMCOM="Owner")]})
    r = one(build_product("FAT_ORCAMENTO_OPEX", b, P))
    assert (r.ORCADO, r.REALIZADO, r.PROD, r.DONO, r.QUARTER, r.COORD) == \
        (Decimal("100"), Decimal("50"), "Produtivo", "Owner", "Q2", None)


def _trace_bronze(spark):
    return FakeBronze(spark, {
        "E140IPV": [dict(CODEMP=1, CODFIL=1, CODSNF="S", NUMNFV=1, SEQIPV=1, NUMPED=2, SEQIPD=1, CODPRO="P1",
                         CODDEP="EXP", QTDFAT=1)],
        "E140NFV": [dict(CODEMP=1, CODFIL=1, CODSNF="S", NUMNFV=1, CODCLI=5, CODREP=7, DATEMI=TS(2024, 1, 1, 8))],
        "E085CLI": [dict(CODCLI=5, NOMCLI="c")], "E090REP": [dict(CODREP=7, USU_CODRAM="R")],
        "E026RAM": [dict(CODRAM="R", DESRAM="ram")], "E075PRO": [dict(CODEMP=1, CODPRO="P1", DESPRO="d")],
        "E120IPD": [dict(CODEMP=1, CODFIL=1, NUMPED=2, SEQIPD=1, TNSPRO="90171")],
        "USU_T140QRC": [dict(USU_CODEMP=1, USU_CODFIL=1, USU_CODSNF="S", USU_NUMNFV=1, USU_SEQIPV=1,
                             USU_CODBAR="B1", USU_DATGER=TS(2024, 1, 2))]})


def test_traceability_chain_and_mix_sheet(spark):
    df = build_product("FAT_RASTREABILIDADE", _trace_bronze(spark), P)
    r = one(df)
    assert r.CODBAR == "B1" and r.MIX is None and r.CODFOR is None
    mix = spark.createDataFrame([(" P1 ", "M1", "O1"), ("P1", "M2", "O2")], "Cd_Item string, Cd_Com_Mix string, "
                                                                            "Cd_Com_Ori string")
    fan = build_product("FAT_RASTREABILIDADE", _trace_bronze(spark), P, sheet=mix)
    assert sorted(r.MIX for r in fan.collect()) == ["M1", "M2"]          # duplicated sheet key fans out


def test_production_products_legacy_preference(spark):
    b = FakeBronze(spark, {
        "E075PRO": [dict(CODEMP=1, CODPRO="A", CODORI="FAB", USU_INDFDL=" "),
                    dict(CODEMP=1, CODPRO="B", CODORI="FAB"), dict(CODEMP=1, CODPRO="S", CODORI="SER")],
        "E075DER": [dict(CODEMP=1, CODPRO="A", CODDER="01"), dict(CODEMP=1, CODPRO="A", CODDER="02"),
                    dict(CODEMP=1, CODPRO="B", CODDER="05"), dict(CODEMP=1, CODPRO="B", CODDER="03")]})
    legacy = spark.createDataFrame([(1, "A", "02")], "CODEMP long, CODPRO string, CODDER string")
    df = build_product("DIM_PRODUTO_PRODUCAO", b, P, legacy=legacy)
    got = {r.CODPRO: (r.CODDER, r.USU_INDFDL) for r in df.collect()}
    assert got == {"A": ("02", "N"), "B": ("03", "N")}
    assert "PRIORIDADE_LEGADO" not in df.columns
    again = build_product("DIM_PRODUTO_PRODUCAO", FakeBronze(spark, b.data), P, legacy=legacy.repartition(3))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, df.collect()))


def test_cost_centres_null_safe_keys_and_idempotent_upsert(spark):
    b = FakeBronze(spark, {
        "E720OPR": [dict(CODEMP=1, CODOPR="OP1", CODCCU="CC1", CODETG="10", CODCRE="R1")],
        "E725CRE": [dict(CODEMP=1, CODCRE="R1", CODCCU="CC1"), dict(CODEMP=1, CODCRE="7020", CODCCU="CC2")],
        "E044CCU": [dict(CODEMP=1, CODCCU="CC1", DESCCU="one")]})
    df = build_product("DIM_CENTRO_CUSTO_PRODUCAO", b, P, listed_resources=["7020"])
    r = one(df, CODCRE="7020")
    assert (r.CODETG, r.CODOPR, r.DESETG) == ("0", " ", " ")
    target = VersionedTable(spark, scratch_path(spark, "dim_cc"))
    n1 = load_product("DIM_CENTRO_CUSTO_PRODUCAO", df, target, "2024-03-01 00:00:00")
    n2 = load_product("DIM_CENTRO_CUSTO_PRODUCAO", df, target, "2024-03-02 00:00:00")
    assert n1 == n2 == 2                                               # NULL key never duplicates


def test_standard_cost_sheet(spark):
    sheet = spark.createDataFrame([(" A1 ", "12,5", "1"), ("", "3,0", "1"), ("B", None, "x"), ("C", "abc", "1")],
                                  "produto string, ` Custo_Padrao ` string, codempresa string")
    from tierwise.plans.products.production import standard_cost_rejects
    df = build_product("DIM_CUSTO_PADRAO_PRODUCAO", sheet=sheet)
    assert [(r.PRODUTO, r.CUSTO_PADRAO, r.CODEMPRESA) for r in df.collect()] == [(" A1 ", 12.5, 1)]
    assert standard_cost_rejects(sheet).count() == 1


def test_stoppages_strict_cutoff_and_hours(spark):
    b = FakeBronze(spark, {
        "E930MPR": [dict(CODEMP=1, CODETG="E", CODMTV="M", DATMPR=TS(2024, 1, 1), HORINI=125, HORFIM=5, SEQMPR=1),
                    dict(CODEMP=1, CODETG="E", CODMTV="M", DATMPR=TS(2024, 1, 2), HORINI=125, HORFIM=5, SEQMPR=2)],
        "E018MTV": [dict(CODEMP=1, CODMTV="M", USU_TIPMTV=1, USU_CLAMTV=2)],
        "E093ETG": [dict(CODEMP=1, CODETG="E", CODCCU="C")]})
    r = one(build_product("FAT_PARADAS_PRODUCAO", b, P))              # the row exactly on the cutoff is out
    assert (r.SEQMPR, r.HORINI, r.HORFIM, r.HORCHA, r.DESTIP, r.DESCLA, r.CODCCU) == \
        (2, Decimal("2.08"), Decimal("0.08"), 125, "Programado", "Manutencao", "C")


def test_budget_entries_text_range_and_numeric_floor(spark):
    b = FakeBronze(spark, {
        "E626ORC": [dict(CODEMP=1, NUMMTC=1601, CODCCU="4100", CODNTG="N"),
                    dict(CODEMP=1, NUMMTC=1601, CODCCU="41", CODNTG="N"),
                    dict(CODEMP=1, NUMMTC=1601, CODCCU="4300", CODNTG="N"),
                    dict(CODEMP=1, NUMMTC=1600, CODCCU="4100", CODNTG="N")],
        "E047NTG": [dict(CODEMP=1, CODNTG="N", DESNTG="n")],
        "E621MTC": [dict(CODEMP=1, NUMMTC=1601, TIPMTC="31", DATINI=TS(2024, 1, 1)),
                    dict(CODEMP=1, NUMMTC=1600, TIPMTC="1", DATINI=TS(2024, 1, 1))]})
    df = build_product("FAT_CUSTO_CC_PRODUCAO", b, P)
    assert sorted(r.CODCCU for r in df.collect()) == ["41", "4100"]   # text comparison, as in the source
    assert {r.TIPORC for r in df.collect()} == {"REALIZADO"}


def test_utilisation_target(spark):
    sheet = spark.createDataFrame([("2024-01-05", " 10 ", "x", "20", None), ("2023-12-31", "10", "1", "1", "1"),
                                   (None, "10", "1", "1", "1")],
                                  "data string, cd_centrocusto string, min_dia string, dias_uteis string, "
                                  "limite_superior string")
    r = one(build_product("FAT_UTILIZACAO_META_PRODUCAO", params=P, sheet=sheet))
    assert (r.DATA, r.CD_CENTROCUSTO, r.MIN_DIA, r.DIAS_UTEIS, r.LIMITE_SUPERIOR) == \
        (TS(2024, 1, 5), "10", 0.0, 20.0, 0.0)


def test_performance_blocks(spark):
    data = {
        "E900EOQ": [dict(CODEMP=1, CODORI="O", NUMORP=1, CODETG="10", SEQEOQ=1, SEQROT=1, CODCRE="R", CODPRO="P",
                         CODDER="D", CODOPR="OP", DATREA=TS(2024, 2, 10), QTDRE1=4, TMPBRU=6, HORREA=1),
                    dict(CODEMP=1, CODORI="O", NUMORP=1, CODETG="10", SEQEOQ=2, SEQROT=1, CODCRE="R", CODPRO="P",
                         CODDER="D", CODOPR="OP", DATREA=TS(2024, 2, 10), QTDRE1=6, TMPBRU=4, HORREA=1),
                    # order 2: its only reading is before the business cutoff but inside the look-up reach
                    dict(CODEMP=1, CODORI="O", NUMORP=2, CODETG="10", SEQEOQ=1, SEQROT=1, CODCRE="R", CODPRO="P",
                         CODDER="D", CODOPR="OP", DATREA=TS(2023, 8, 1), QTDRE1=1, TMPBRU=1, HORREA=1)],
        "E900COP": [dict(CODEMP=1, CODORI="O", NUMORP=1, CODPRO="P", DTRINI=TS(2024, 1, 15), DTRFIM=TS(2024, 3, 1),
                         SITORP="A")],
        "E900OOP": [dict(CODEMP=1, CODORI="O", NUMORP=1, CODETG="10", SEQROT=1, SFXETR="1", SFXSEQ="1",
                         CODOPR="OP", UNICRE="H", TMPPRP=2)],
        "E093ETG": [dict(CODEMP=1, CODETG="10", CODCCU="STAGE-CC")],
        "E725CRE": [dict(CODEMP=1, CODCRE="R", CODCCU=" ")],
        "E900QDO": [dict(CODEMP=1, CODORI="O", NUMORP=1, CODPRO="P", CODDER="D", QTDPRV=3, QTDRFG=1)],
        "E630SPE": [dict(CODEMP=1, CODORI="O", NUMORP=1, CODPRO="P", CODETG="99", SDOATU=7)],
        "E621MTC": [dict(CODEMP=1, NUMMTC=1, TIPMTC="28", DATINI=TS(2024, 2, 1), DATFIM=TS(9999, 12, 31)),
                    dict(CODEMP=1, NUMMTC=1601, TIPMTC="31", DATINI=TS(2024, 1, 1))],
        "E626TAX": [dict(CODEMP=1, NUMMTC=1, CODCCU="STAGE-CC", CODGNG="g", TAXCUS=5)],
        "E210MVP": [dict(CODEMP=1, CODPRO="MP", CODDER="D", CODDEP="X", DATMOV=TS(2024, 2, 11), SEQMOV=1,
                         CODETG="10", CODTNS="90251", NUMDOC=1, ORIORP="O", ESTEOS="E", QTDMOV=2, VLRMOV=8),
                    dict(CODEMP=1, CODPRO="MP", CODDER="D", CODDEP="X", DATMOV=TS(2024, 2, 10), SEQMOV=2,
                         CODETG="10", CODTNS="90202", NUMDOC=1, ORIORP="O", ESTEOS="S", QTDMOV=1, VLRMOV=3),
                    dict(CODEMP=1, CODPRO="MP", CODDER="D", CODDEP="X", DATMOV=TS(2024, 2, 12), SEQMOV=3,
                         CODETG="10", CODTNS="90251", NUMDOC=2, ORIORP="O", ESTEOS="S", QTDMOV=1, VLRMOV=1)],
        "E075PRO": [dict(CODEMP=1, CODPRO="MP", TIPPRO="P", CODFAM="F")],
        "E930MPR": [dict(CODEMP=1, CODFIL=1, CODETG="10", CODCRE="R", IDEBEM="b", DATMPR=TS(2024, 2, 5),
                         CODMTV="M", SEQMPR=1, QTDHOR=2, HORINI=60)],
        "E626ORC": [dict(CODEMP=1, NUMMTC=1601, CODCCU="4100", CODNTG="N", VALVIS=9)],
    }
    df = build_product("FAT_DESEMPENHO_PRODUCAO", FakeBronze(spark, data), P)
    rows = {r.TIPTAB: r for r in df.collect() if r.TIPTAB != 2}
    assert set(rows) == {1, 3, 4}
    b1 = rows[1]
    assert b1.CC_EXE == "STAGE-CC"                                     # blank resource centre -> stage's
    assert b1.QTDREA == Decimal("10") and b1.TMPBRU == Decimal("10")   # correlated sums, averaged
    assert b1.QTDAND == Decimal("7")                                   # different month -> rework balance
    assert b1.TAXREA == Decimal("5")                                   # rate valid on the day
    assert b1.TMPPRP == Decimal("240") and b1.TMPPRV == Decimal("1440")  # 2 x 2 rows x 60; x QTDPRV 6
    assert {r.NUMORP for r in df.collect() if r.TIPTAB == 1} == {1}       # order 2 predates the cutoff
    reach = one(df, TIPTAB=2, NUMORP=2)
    assert reach.DATREA == TS(2023, 8, 1)                              # look-up reach, not the cutoff (FIL-06)
    b2 = {r.DATMOV: r for r in df.collect() if r.TIPTAB == 2 and r.NUMORP == 1}
    late, same = b2[TS(2024, 2, 11)], b2[TS(2024, 2, 10)]
    assert late.DATREA == TS(2024, 2, 10)                              # no same-day reading -> latest
    assert (late.QTDTOP, late.CODCRE, late.CC_EXE) == (None, None, None)   # T3 left join found nothing
    assert (late.QTDCOR, late.CUSMOV, late.CD_TIPO_MP_PERSONALIZADO) == (Decimal("2"), Decimal("-8"), "CO")
    assert (same.DATREA, same.QTDTOP, same.CODCRE, same.CC_EXE, same.CUSMOV) == \
        (TS(2024, 2, 10), Decimal("10"), "R", "STAGE-CC", Decimal("3"))
    assert rows[3].CC_EXE == "STAGE-CC" and rows[4].VALVIS == Decimal("9")


def test_rma_sheets(spark):
    idx = spark.createDataFrame([(1, "a"), (None, "b")], "` id ` int, name string")
    assert build_product("DIM_INDICE_RMA", sheet=idx).count() == 1
    defects = spark.createDataFrame([(" P1 ", "7", "x"), ("nan", "1", "y"), ("P2", " ", "z"), ("P3", None, "w")],
                                    "produto string, `código` string, extra string")
    d = build_product("DIM_RECLASSIF_DEFEITOS", sheet=defects)
    assert [(r.PRODUTO, r.PROD_COD_DEF) for r in d.collect()] == [("P1", "P1|7")]
    prods = spark.createDataFrame([(" 10 ", "A"), ("", "B")], "`Cód. Produto` string, `Classificação` string")
    pr = build_product("DIM_RECLASSIF_PRODUTOS", sheet=prods)
    assert pr.columns == ["CD_PRODUTO", "DS_CLASSIF_PROD"] and pr.count() == 1


def test_rma_sales_trailing_months(spark):
    def note(n, day):
        return dict(CODEMP=1, CODFIL=1, CODSNF="S", NUMNFV=n, DATEMI=day, SITNFV="2", TIPNFS=9)
    months = [(1, TS(2023, 7, 3)), (2, TS(2023, 12, 20)), (3, TS(2024, 1, 10)), (4, TS(2024, 3, 1))]
    b = FakeBronze(spark, {
        "E140NFV": [note(n, d) for n, d in months],
        "E140IPV": [dict(CODEMP=1, CODFIL=1, CODSNF="S", NUMNFV=n, CODPRO="X", TNSPRO="T", QTDFAT=n * 10)
                    for n, _ in months],
        "E140IDE": [dict(CODEMP=1, CODFIL=1, CODSNF="S", NUMNFV=n, SITDOE=3) for n, _ in months],
        "E001TNS": [dict(CODEMP=1, CODTNS="T", VENFAT="S")]})
    df = build_product("FAT_VENDAS_RMA", b, P)
    got = {r.DATREF: (r.QTDMED, r.VENDA_MES_ANO_PRODUTO, r.DATINI) for r in df.collect()}
    assert got == {D(2024, 1, 31): (Decimal("30"), "1|2024|X", D(2023, 7, 1)),      # Jul + Dec, cutoff after window
                   D(2024, 3, 31): (Decimal("50"), "3|2024|X", D(2023, 9, 1))}      # Dec + Jan


def test_report_items_derived_columns(spark):
    item = lambda lau, serial, nfc: dict(USU_CODEMP=1, USU_CODFIL=1, USU_CODLAU=lau, USU_SEQIPC=1,  # noqa
                                         USU_SEQUNI=1, USU_CODFOR="F", USU_NUMNFC=nfc, USU_SERMAC=serial,
                                         USU_CODPRO="P", USU_CODDEF="14.0")
    b = FakeBronze(spark, {
        "USU_TLAUITE": [item("L1", "SN1", 1), item("L2", "SN1", 2), item("L3", "S/N", 3)],
        "USU_TLAUGER": [dict(USU_CODEMP=1, USU_CODFIL=1, USU_CODLAU="L1", USU_CODSIT="3",
                             USU_DATSEP=TS(2024, 1, 15), USU_NUMNFV=50),
                        dict(USU_CODEMP=1, USU_CODFIL=1, USU_CODLAU="L2", USU_CODSIT="1",
                             USU_DATSEP=TS(2024, 2, 1))],
        "E440NFC": [dict(CODEMP=1, CODFIL=1, CODFOR="F", NUMNFC=1, DATENT=TS(2024, 1, 5)),
                    dict(CODEMP=1, CODFIL=1, CODFOR="F", NUMNFC=2, DATENT=TS(2024, 2, 25)),
                    dict(CODEMP=1, CODFIL=1, CODFOR="F", NUMNFC=3, DATENT=TS(2024, 2, 26))],
        "E095FOR": [dict(CODFOR="F", SIGUFS="SP")],
        "E075PRO": [dict(CODEMP=1, CODPRO="P", ORIMER="6")],
        "E140NFV": [dict(CODEMP=1, CODFIL=1, NUMNFV=50, CODTRA="T", USU_ENTCOR=TS(2024, 1, 20))],
        "E073TRA": [dict(CODTRA="T", APETRA="CORREIO / SEDEX")]})
    df = build_product("FAT_LAUDOS", b, P)
    r1, r2, r3 = one(df, USU_CODLAU="L1"), one(df, USU_CODLAU="L2"), one(df, USU_CODLAU="L3")
    assert (r1.DS_PRAZO, r1.DIAS_PRAZO_LAUDO, r1.DT_ANO_FINALIZ, r1.PROD_COD_DEF, r1.VENDA_MES_ANO_PRODUTO) == \
        ("Finalizado no Prazo", 10, "2024", "P|14", "1|2024|P")
    assert (r1.MACRO_REGIAO, r1.DS_ORIGEM_FISCAL, r1.DS_TIPO_TRANSPORTE, r1.DS_TRANSPORTADORA_ENTREGA) == \
        ("Sudeste", "Importado", "Correios", "CORREIO / SEDEX")
    assert (r1.DIAS_ENTREGA, r1.DS_CLASSIF_ENTREGA) == (15, "Entre 11 e 20 Dias")
    assert (r1.REINCIDENTE, r2.REINCIDENTE, r2.DIAS_REINCIDENCIA, r3.REINCIDENTE) == (0, 1, 51, 2)
    assert (r2.DATFIN, r2.DS_PRAZO, r2.DIAS_PRAZO_LAUDO) == (None, "Em Aberto no Prazo", 5)
    assert r2.DS_TIPO_TRANSPORTE == "Sem NFSaída" and r2.DS_CLASSIF_ENTREGA == "Sem Data"
