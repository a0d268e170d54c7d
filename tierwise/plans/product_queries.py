"""Silver products over the test tables, and independent SQL for them.

The test tables are projected whole onto bronze-shaped frames (``BRONZE``: the
columns a product reads, as expressions both engines understand); the product's own
builder runs on them.  The SQL states the product's rule anew over the same frames.
Decimal results are returned as DOUBLE on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from .products import ProductParams, build_product

# frame: (test table, distinct, [(column, expression)])
BRONZE = {
    "E028CPG": ("orders", False, [
        ("CODEMP", "CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END"), ("CODCPG", "'' || o_orderkey"),
        ("DESCPG", "'  ' || lower(o_orderpriority) || ' '"), ("PRZMED", "o_custkey % 90"), ("ABRCPG", "o_orderstatus"),
        ("QTDPAR", "o_custkey % 12"), ("SITCPG", "CASE WHEN o_custkey % 3 = 0 THEN 'A' ELSE 'I' END"),
        ("DATGER", "o_orderdate"), ("DATATU", "o_orderdate + INTERVAL 3 DAY")]),
    "E075DER": ("part", False, [
        ("CODEMP", "CASE WHEN p_size % 5 = 0 THEN 2 ELSE 1 END"), ("CODPRO", "'' || (p_partkey % 700)"),
        ("CODDER", "CASE WHEN p_size % 4 = 0 THEN ' ' WHEN p_size % 4 = 1 THEN NULL ELSE p_brand END"), ("CODAGT", "p_type"),
        ("CODGTN", "'' || p_partkey"), ("SITDER", "CASE WHEN p_size % 3 = 0 THEN 'A' ELSE 'I' END"), ("COMDER", "p_size"),
        ("ALTDER", "p_size * 2"), ("LARDER", "p_size * 3"), ("PESBRU", "p_retailprice"), ("PESLIQ", "p_retailprice"), ("CURABC", "CASE WHEN p_size % 2 = 0 THEN 'A' ELSE 'B' END")]),
    # the variants the legacy table prefers (an input of DIM_PRODUTO_PRODUCAO), and the override tables of DIM_REGIONAL
    "LEGACY": ("part", True, [("CODEMP", "1"), ("CODPRO", "'' || (p_partkey % 700)"), ("CODDER", "max(p_brand) OVER (PARTITION BY p_partkey % 700)")]),
    "BY_REGION": ("nation", False, [("ID_REGIONAL", "n_nationkey * 6"), ("RESPONSAVEL", "'BY REGION ' || n_nationkey")]),
    "BY_LOGIN": ("customer", False, [("LOGIN", "CASE WHEN c_custkey % 4 = 0 THEN lower(replace(replace(c_name, '#', '.'), '0', '')) END"), ("RESPONSAVEL", "'BY LOGIN ' || c_custkey")]),
    "E075PRO": ("part", False, [
        ("CODEMP", "1"), ("CODPRO", "'' || p_partkey"), ("DESPRO", "' ' || p_name"), ("CODCLF", "p_brand"),
        ("PERIPI", "CAST(p_size AS DECIMAL(18,4))"), ("USU_INDFDL", "CASE WHEN p_size % 3 = 0 THEN 'S' ELSE 'N' END"), ("CODFAM", "p_brand"), ("UNIMED", "'UN'"), ("TIPPRO", "p_type"),
        ("CODORI", "CASE WHEN p_size % 8 = 0 THEN 'SER' ELSE 'PRO' END"), ("CODAGE", "'A' || p_size"), ("SITPRO", "'A'"), ("DEPPAD", "'D' || (p_size % 4)")]),
    "E013AGP": ("part", True, [("CODEMP", "1"), ("CODAGP", "p_type"), ("DESAGP", "' ' || p_type")]),
    "E022CLF": ("part", True, [("CODCLF", "p_brand"), ("CLAFIS", "'N' || p_brand"), ("CODCES", "'C' || p_brand")]),
    "E090REP": ("customer", False, [
        ("CODREP", "c_custkey"), ("CGCCPF", "c_custkey * 7919"), ("TIPREP", "CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'J' END"),
        ("NOMREP", "' ' || lower(c_name)"), ("APEREP", "c_name"), ("USU_TIPREP", "'' || (c_custkey % 5)"),
        ("SITWMW", "CASE WHEN c_custkey % 3 = 0 THEN 'A' ELSE 'I' END"), ("USU_CODRAM", "lower(c_mktsegment)"),
        ("CIDREP", "'city ' || c_nationkey"), ("SIGUFS", "'sp '"), ("FONREP", "'(' || c_custkey || ') 5-' || c_nationkey"),
        ("INTNET", "'A' || c_custkey || '@X.COM '"), ("USU_CODRVR", "c_nationkey"), ("DATCAD", "make_date(2000, 1 + c_nationkey % 12, 3)")]),
    "E026RAM": ("customer", True, [("CODRAM", "lower(c_mktsegment)"), ("DESRAM", "' ' || lower(c_mktsegment)")]),
    "USU_T017RVR": ("nation", False, [("USU_CODRVR", "n_nationkey"), ("USU_NOMRVR", "lower(n_name)"), ("USU_USUCOR", "CASE WHEN n_nationkey % 5 = 4 THEN NULL ELSE n_nationkey * 2 END"),
                                       ("USU_USUASS", "n_nationkey * 3 + 100"), ("USU_DATGER", "make_date(2001, 1 + n_nationkey % 12, 5)")]),
    "R999USU": ("customer", False, [("CODUSU", "c_custkey"), ("NOMUSU", "replace(replace(c_name, '#', '.'), '0', '')")]),
    "USU_T101MET": ("lineitem", False, [
        ("USU_CODEMP", "CASE WHEN l_linenumber = 7 THEN 2 ELSE 1 END"), ("USU_MESANO", "make_date(year(l_shipdate), month(l_shipdate), 1)"),
        ("USU_CODTIP", "l_partkey % 5"), ("USU_SEQREG", "l_orderkey"), ("USU_CODCRI", "l_suppkey % 6"), ("USU_CODRVR", "l_suppkey % 30"),
        ("USU_CODREP", "l_orderkey % 2000"), ("USU_CODAGP", "CASE WHEN l_partkey % 2 = 0 THEN 'PROMO' ELSE 'SMALL' END"), ("USU_CODPRO", "'' || l_partkey"),
        ("USU_VLRMET", "l_extendedprice"), ("USU_PESCRI", "l_linenumber"), ("USU_DATGER", "l_shipdate"), ("USU_NOMUSU", "' ' || lower(l_returnflag)")]),
    "USU_T101TIP": ("nation", False, [("USU_CODTIP", "n_nationkey"), ("USU_DESTIP", "lower(n_name) || ' '")]),
    "USU_T101CRI": ("nation", False, [
        ("USU_CODCRI", "n_nationkey"), ("USU_DESCRI", "lower(n_name)"), ("USU_UNICRI", "n_nationkey % 4"), ("USU_DIRCRI", "n_nationkey % 3")]),
    "E012FAM": ("part", True, [("CODEMP", "1"), ("CODFAM", "p_brand"), ("DESFAM", "'F ' || p_brand")]),
    "USU_T650CUS": ("lineitem", False, [
        ("USU_CODEMP", "CASE WHEN l_suppkey % 3 = 0 THEN 1 WHEN l_suppkey % 3 = 1 THEN 50 ELSE 2 END"),
        ("USU_MESANO", "make_date(year(l_shipdate), month(l_shipdate), 1)"), ("USU_CODMPC", "CASE WHEN l_linenumber % 2 = 0 THEN '802' ELSE '801' END"),
        ("USU_CTADRE", "l_partkey % 10"), ("USU_CODCCU", "'' || (l_suppkey % 20)"), ("USU_SALMES", "CAST(l_extendedprice AS DECIMAL(18,4))")]),
    "USU_T650ORC": ("orders", False, [
        ("USU_CODEMP", "CASE WHEN o_custkey % 3 = 0 THEN 1 WHEN o_custkey % 3 = 1 THEN 50 ELSE 2 END"),
        ("USU_MESANO", "make_date(year(o_orderdate), month(o_orderdate), 1)"), ("USU_CODMPC", "CASE WHEN o_orderstatus = 'P' THEN '802' ELSE '801' END"),
        ("USU_CTADRE", "o_orderkey % 10"), ("USU_CODCCU", "'' || (o_custkey % 20)"), ("USU_ORCMES", "o_totalprice")]),
    "E044CCU": ("nation", False, [
        ("CODEMP", "CASE WHEN n_nationkey % 3 = 0 THEN 1 WHEN n_nationkey % 3 = 1 THEN 50 ELSE 2 END"), ("CODCCU", "'' || n_nationkey"),
        ("DESCCU", "n_name"), ("ABRCCU", "'C' || n_nationkey"), ("CCUPAI", "'' || n_regionkey"), ("TIPCCU", "n_regionkey"), ("USU_CODRES", "n_nationkey + 1"), ("USU_CODCOR", "n_regionkey + 100000000")]),
    "R910USU": ("customer", False, [("CODENT", "c_custkey"), ("NOMCOM", "c_name")]),
    "E043PCM": ("part", False, [("CTARED", "p_partkey"), ("CODMPC", "'801'"), ("DESCTA", "p_name")]),
    "E930MPR": ("lineitem", False, [
        ("CODEMP", "50"), ("CODMTV", "l_suppkey"), ("CODETG", "'' || l_linenumber"), ("CODCRE", "'' || (l_partkey % 40)"), ("IDEBEM", "l_returnflag"),
        ("DATMPR", "l_shipdate"), ("SEQMPR", "l_linenumber"), ("HORINI", "l_orderkey % 1440"), ("HORFIM", "(l_orderkey * 7) % 1440")]),
    "E018MTV": ("supplier", False, [
        ("CODEMP", "50"), ("CODMTV", "s_suppkey"), ("DESMTV", "s_name"), ("ABRMTV", "'S' || s_suppkey"), ("USU_TIPMTV", "s_suppkey % 3"), ("USU_CLAMTV", "s_suppkey % 7")]),
    "E093ETG": ("nation", False, [
        ("CODEMP", "CASE WHEN n_nationkey < 12 THEN 50 ELSE 1 END"), ("CODETG", "'' || (n_nationkey % 12)"), ("CODCCU", "'' || (n_nationkey * 3 - 2)"),
        ("DESETG", "n_name"), ("ABRETG", "'E' || n_nationkey")]),
    "E720OPR": ("lineitem", True, [
        ("CODEMP", "1"), ("CODCCU", "'' || (l_suppkey % 25)"), ("CODETG", "'' || l_linenumber"), ("CODCRE", "'' || (l_partkey % 40)"),
        ("CODOPR", "CASE WHEN l_orderkey % 9 = 0 THEN NULL ELSE '' || (l_orderkey % 9) END"), ("DESOPR", "'op ' || l_returnflag"), ("ABROPR", "l_returnflag"),
        ("UNICRE", "'M'"), ("MOVORP", "l_linestatus")]),
    "E725CRE": ("supplier", False, [
        ("CODEMP", "1"), ("CODCRE", "'' || s_suppkey"), ("DESCRE", "s_name"), ("ABRCRE", "'R' || s_suppkey"), ("CODCCU", "'' || s_nationkey")]),
    "E626ORC": ("lineitem", False, [
        ("CODEMP", "1"), ("CODNTG", "l_partkey"), ("NUMMTC", "l_suppkey + 1550"), ("CODCCU", "'' || (3900 + l_orderkey % 500)")]),
    "E047NTG": ("part", False, [("CODEMP", "1"), ("CODNTG", "p_partkey"), ("DESNTG", "p_name")]),
    "E621MTC": ("supplier", False, [
        ("CODEMP", "1"), ("NUMMTC", "s_suppkey + 1550"), ("TIPMTC", "CASE WHEN s_suppkey % 2 = 0 THEN '31' ELSE '28' END"), ("CODMTC", "'' || s_nationkey"),
        ("DESMTC", "s_name"), ("DATINI", "make_date(1995 + s_nationkey % 8, 1 + s_nationkey % 12, 1)"), ("DATFIM", "make_date(2010, 1 + s_nationkey % 12, 1)")]),
    "E140NFV": ("orders", False, [
        ("CODEMP", "1"), ("CODFIL", "1"), ("CODSNF", "'S'"), ("NUMNFV", "o_orderkey"), ("DATEMI", "o_orderdate"),
        ("SITNFV", "CASE WHEN o_orderstatus = 'P' THEN '1' ELSE '2' END"), ("TIPNFS", "o_custkey % 10"), ("CODCLI", "o_custkey"), ("CODREP", "o_custkey % 500")]),
    "E140IPV": ("lineitem", False, [
        ("CODEMP", "1"), ("CODFIL", "1"), ("CODSNF", "'S'"), ("NUMNFV", "l_orderkey"), ("CODPRO", "'' || (l_partkey % 50)"),
        ("QTDFAT", "CAST(l_quantity AS DECIMAL(18,4))"), ("TNSPRO", "l_returnflag"), ("NUMPED", "l_orderkey"), ("SEQIPD", "l_linenumber"), ("SEQIPV", "l_linenumber"),
        ("CODDEP", "CASE l_linenumber % 3 WHEN 0 THEN 'EXP' WHEN 1 THEN 'E-COMMERCE' ELSE 'OUT' END")]),
    "E120IPD": ("lineitem", True, [
        ("CODEMP", "1"), ("CODFIL", "1"), ("NUMPED", "l_orderkey"), ("SEQIPD", "l_linenumber"), ("TNSPRO", "CASE l_linenumber % 2 WHEN 0 THEN '90999' ELSE '90100' END")]),
    "E085CLI": ("customer", False, [
        ("CODCLI", "c_custkey"), ("NOMCLI", "c_name"), ("APECLI", "lower(c_name)"), ("TIPCLI", "'J'"), ("SIGUFS", "'SP'"), ("CIDCLI", "'' || c_nationkey"), ("CODRAM", "c_mktsegment")]),
    "USU_T140QRC": ("lineitem", False, [
        ("USU_CODEMP", "1"), ("USU_CODFIL", "1"), ("USU_CODSNF", "'S'"), ("USU_NUMNFV", "l_orderkey"), ("USU_SEQIPV", "l_linenumber"),
        ("USU_CODBAR", "'B' || l_orderkey || '-' || l_linenumber"), ("USU_DATGER", "l_shipdate")]),
    "USU_VZRASLAU": ("orders", False, [
        ("USU_CODBAR", "'B' || o_orderkey || '-1'"), ("EMPNFV", "1"), ("FILNFV", "1"), ("CODFOR", "o_custkey"), ("NOMFOR", "o_orderpriority"), ("NUMOCP", "o_orderkey"),
        ("USU_NUMINV", "o_custkey + 1"), ("NUMNFC", "o_orderkey + 1"), ("DATEMIOCP", "o_orderdate"), ("USU_DATEMB", "o_orderdate + INTERVAL 1 DAY"),
        ("DATEMINFC", "o_orderdate + INTERVAL 2 DAY"), ("DATENTNFC", "o_orderdate + INTERVAL 3 DAY")]),
    "E140IDE": ("orders", False, [
        ("CODEMP", "1"), ("CODFIL", "1"), ("CODSNF", "'S'"), ("NUMNFV", "o_orderkey"), ("SITDOE", "CASE WHEN o_orderkey % 4 = 0 THEN 2 ELSE 3 END")]),
    "E001TNS": ("lineitem", True, [("CODEMP", "1"), ("CODTNS", "l_returnflag"), ("VENFAT", "CASE WHEN l_returnflag = 'R' THEN 'N' ELSE 'S' END")]),
}
# sheet of a product: (test table, [(header as written in the sheet, expression)])
SHEETS = {
    "FAT_UTILIZACAO_META_PRODUCAO": ("lineitem", [
        ("Data", "'' || CAST(l_shipdate AS DATE)"), (" CD_CentroCusto", "CASE WHEN l_linenumber = 7 THEN NULL ELSE ' ' || (l_suppkey % 9) END"),
        ("Min_Dia", "CASE WHEN l_partkey % 4 = 0 THEN 'x' ELSE '' || (l_partkey % 480) END"), ("Dias_Uteis", "'' || (l_orderkey % 23)"),
        ("Limite_Superior", "'1.' || (l_orderkey % 7)"), ("Nota", "l_returnflag")]),
    "DIM_CUSTO_PADRAO_PRODUCAO": ("part", [
        ("Produto", "CASE WHEN p_size % 7 = 0 THEN ' ' ELSE 'P' || p_partkey END"), ("CodEmpresa", "CASE WHEN p_size % 5 = 0 THEN 'um' ELSE '1' END"),
        ("Custo_Padrao", "CASE WHEN p_size % 11 = 0 THEN '12D' WHEN p_size % 13 = 0 THEN NULL ELSE p_size || ',25' END")]),
    "DIM_INDICE_RMA": ("part", [("id ", "CASE WHEN p_size % 5 = 0 THEN NULL ELSE 'I' || p_partkey END"), ("Nome", "p_name")]),
    "DIM_RECLASSIF_DEFEITOS": ("part", [
        ("Produto", "CASE WHEN p_size % 5 = 0 THEN ' ' ELSE ' P' || p_partkey END"), ("Código", "CASE WHEN p_size % 7 = 0 THEN 'NaN' ELSE p_size || ' ' END"), ("Nova", "p_brand")]),
    "DIM_RECLASSIF_PRODUTOS": ("part", [
        ("Cód. Produto", "CASE WHEN p_size % 5 = 0 THEN NULL ELSE ' P' || p_partkey END"), ("Novo Código", "p_brand"), ("Situação", "p_type || ' '"), ("Outra", "p_name")]),
}
LISTED_RESOURCES = ("3", "7", "900")
PARAMS = ProductParams(as_of="2002-01-01 00:00:00", production_cutoff="1999-06-15", reports_cutoff="2000-01-01", trace_cutoff="2000-01-01")


def _bronze(spark, d, frames=BRONZE):
    def frame(name: str) -> DataFrame:
        table, distinct, columns = frames[name]
        df = spark.read.parquet(f"{d}/{table}.parquet").selectExpr(*[f"{e} AS {c}" for c, e in columns])
        return df.distinct() if distinct else df
    return frame


def _sheet(spark, d, product: str) -> DataFrame | None:
    if product not in SHEETS:
        return None
    table, columns = SHEETS[product]
    return spark.read.parquet(f"{d}/{table}.parquet").selectExpr(*[f"{e} AS `{c}`" for c, e in columns])


def _query(product: str, frames=BRONZE, params=PARAMS, **inputs):
    """``inputs``: keyword inputs of the builder, a frame's name or a value."""
    def run(spark, d) -> DataFrame:
        bronze = _bronze(spark, d, frames)
        df = build_product(product, bronze, params, sheet=_sheet(spark, d, product),
                           **{k: bronze(v) if v in frames else v for k, v in inputs.items()})
        return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name) for f in df.schema.fields])
    return run


def _sheet_sql(product: str, body: str) -> str:
    table, columns = SHEETS[product]
    return "WITH s AS (SELECT " + ", ".join(f'{e} AS "{c.strip().upper()}"' for c, e in columns) + f" FROM {table})\n" + body


def _sql(names: str, body: str, frames=BRONZE) -> str:
    ctes = []
    for name in names.split():
        table, distinct, columns = frames[name]
        ctes.append(f"{name} AS (SELECT {'DISTINCT ' if distinct else ''}" + ", ".join(f"{e} AS {c}" for c, e in columns) + f" FROM {table})")
    return "WITH " + ",\n".join(ctes) + "\n" + body


PRODUCT_QUERIES = {
    "dp01_payment_terms": _query("DIM_CONDICAO_PAGAMENTO"),
    "dp02_product_variants": _query("DIM_PRODUTO"),
    "dp03_sales_reps": _query("DIM_REPRESENTANTE"),
    "dp04_regions": _query("DIM_REGIONAL", by_region="BY_REGION", by_login="BY_LOGIN"),
    "dp05_targets": _query("FAT_METAS"),
    "dp08_opex_budget": _query("FAT_ORCAMENTO_OPEX"),
    "dp09_traceability": _query("FAT_RASTREABILIDADE"),
    "dp10_production_products": _query("DIM_PRODUTO_PRODUCAO", legacy="LEGACY"),
    "dp11_cost_centres": _query("DIM_CENTRO_CUSTO_PRODUCAO", listed_resources=LISTED_RESOURCES),
    "dp12_standard_cost": _query("DIM_CUSTO_PADRAO_PRODUCAO"),
    "dp13_stoppages": _query("FAT_PARADAS_PRODUCAO"),
    "dp14_budget_entries": _query("FAT_CUSTO_CC_PRODUCAO"),
    "dp15_utilisation_target": _query("FAT_UTILIZACAO_META_PRODUCAO"),
    "dp17_rma_index": _query("DIM_INDICE_RMA"),
    "dp18_defect_reclassification": _query("DIM_RECLASSIF_DEFEITOS"),
    "dp19_product_reclassification": _query("DIM_RECLASSIF_PRODUTOS"),
    "dp20_rma_sales": _query("FAT_VENDAS_RMA"),
}

PRODUCT_ORACLE = {
    "dp01_payment_terms": _sql("E028CPG", """
SELECT CODCPG, upper(trim(DESCPG)) AS DESCPG, PRZMED || ' PM - ' || upper(trim(DESCPG)) AS DESCPGTO, ABRCPG AS ABREVCPG, PRZMED,
       QTDPAR AS QTDPARC, SITCPG, CASE SITCPG WHEN 'A' THEN 'ATIVA' ELSE 'INATIVA' END AS SITCPG_DESC,
       strftime(DATGER, '%d/%m/%Y') AS DATCAD, strftime(DATATU, '%d/%m/%Y') AS ULTATU
FROM E028CPG WHERE CODEMP = 1"""),
    "dp02_product_variants": _sql("E075DER E075PRO E013AGP E022CLF", """
SELECT D.CODAGT AS CATEGORIAID, trim(M.DESAGP) AS CATEGORIA,
       CASE WHEN D.CODDER IS NULL OR trim(D.CODDER) = '' THEN D.CODPRO ELSE D.CODPRO || '-' || D.CODDER END AS CHAVE_ITEM,
       P.CODPRO AS CODITEM, upper(trim(P.DESPRO)) AS DESCITEM, N.CLAFIS AS CODNCM, D.CODGTN AS CODEAN, N.CODCES AS CODCEST,
       CAST(P.PERIPI AS DOUBLE) / 100 AS PERIPI, CASE D.SITDER WHEN 'A' THEN 'ATIVO' ELSE 'INATIVO' END AS SITITEM,
       P.USU_INDFDL AS FORALINHA, D.COMDER AS COMPRIMENTO, D.ALTDER AS ALTURA, D.LARDER AS LARGURA, D.PESBRU AS PESOBRUTO, D.PESLIQ AS PESOLIQ
FROM E075DER D LEFT JOIN E075PRO P ON P.CODEMP = D.CODEMP AND P.CODPRO = D.CODPRO
LEFT JOIN E013AGP M ON M.CODEMP = P.CODEMP AND M.CODAGP = D.CODAGT LEFT JOIN E022CLF N ON N.CODCLF = P.CODCLF
WHERE D.CODEMP = 1"""),
    "dp03_sales_reps": _sql("E090REP E026RAM USU_T017RVR", """
SELECT R.CODREP, lpad('' || R.CGCCPF, CASE R.TIPREP WHEN 'F' THEN 11 ELSE 14 END, '0') AS DOCREP, upper(trim(R.NOMREP)) AS NOMEREP,
       upper(trim(R.APEREP)) AS APEREP, CASE R.USU_TIPREP WHEN '1' THEN 'VENDEDOR' WHEN '2' THEN 'RCA' WHEN '3' THEN 'B2C' ELSE 'OUTROS' END AS TIPOREP,
       CASE R.SITWMW WHEN 'A' THEN 'ATIVO' ELSE 'INATIVO' END AS SITREP, upper(R.USU_CODRAM) AS CODRAMO, upper(trim(M.DESRAM)) AS RAMO,
       upper(trim(R.CIDREP)) AS CIDADE, upper(trim(R.SIGUFS)) AS ESTADO, regexp_replace(R.FONREP, '[^0-9]', '', 'g') AS TELEFONE,
       lower(trim(R.INTNET)) AS EMAIL, R.USU_CODRVR AS ID_REGIONAL, upper(trim(G.USU_NOMRVR)) AS NOME_REGIONAL, CAST(R.DATCAD AS DATE) AS DT_CADASTRO
FROM E090REP R LEFT JOIN E026RAM M ON M.CODRAM = R.USU_CODRAM LEFT JOIN USU_T017RVR G ON G.USU_CODRVR = R.USU_CODRVR"""),
    "dp04_regions": _sql("USU_T017RVR R999USU BY_REGION BY_LOGIN", """
SELECT R.USU_CODRVR AS ID_REGIONAL, upper(R.USU_NOMRVR) AS REGIONAL, 'R' || lpad('' || R.USU_CODRVR, 2, '0') || ' - ' || upper(R.USU_NOMRVR) AS NOME_REGIONAL,
       COALESCE(A.RESPONSAVEL, L.RESPONSAVEL, upper(replace(K.NOMUSU, '.', ' ')), 'NÃO IDENTIFICADO') AS RESPONSAVEL,
       COALESCE(upper(replace(S.NOMUSU, '.', ' ')), 'NÃO IDENTIFICADO') AS ASSISTENTE, R.USU_DATGER AS DT_CADASTRO
FROM USU_T017RVR R LEFT JOIN R999USU K ON K.CODUSU = R.USU_USUCOR LEFT JOIN R999USU S ON S.CODUSU = R.USU_USUASS
LEFT JOIN BY_REGION A ON A.ID_REGIONAL = R.USU_CODRVR LEFT JOIN BY_LOGIN L ON L.LOGIN = lower(K.NOMUSU)"""),
    "dp05_targets": _sql("USU_T101MET USU_T101TIP USU_T101CRI USU_T017RVR E090REP E013AGP E075PRO", """
SELECT M.USU_CODEMP AS CODEMP, M.USU_MESANO AS MESANO, M.USU_CODTIP AS CODTIP, M.USU_SEQREG AS SEQREG, upper(trim(T.USU_DESTIP)) AS DESC_TIPO,
       M.USU_CODCRI AS CODCRI, upper(trim(C.USU_DESCRI)) AS DESC_CRITERIO, C.USU_UNICRI AS UNICRI,
       CASE C.USU_UNICRI WHEN 1 THEN 'QUANTIDADE' WHEN 2 THEN 'VALOR' WHEN 3 THEN 'PERCENTUAL' ELSE 'NÃO DEFINIDO' END AS DESC_UNICRI, C.USU_DIRCRI AS DIRCRI,
       CASE C.USU_DIRCRI WHEN 1 THEN 'MAXIMIZAR' WHEN 2 THEN 'MINIMIZAR' ELSE 'NÃO DEFINIDO' END AS DESC_DIRCRI, M.USU_CODRVR AS CODRVR,
       upper(trim(V.USU_NOMRVR)) AS NOME_REGIONAL, M.USU_CODREP AS CODREP, upper(trim(R.NOMREP)) AS NOME_REP, M.USU_CODAGP AS CODAGP,
       upper(trim(A.DESAGP)) AS DESC_MIX, M.USU_CODPRO AS CODPRO, upper(trim(P.DESPRO)) AS DESC_PRODUTO, M.USU_VLRMET AS VLR_META,
       M.USU_PESCRI AS PESO_CRITERIO, M.USU_DATGER AS DT_CRIACAO, upper(trim(M.USU_NOMUSU)) AS USUARIO
FROM USU_T101MET M LEFT JOIN USU_T101TIP T ON T.USU_CODTIP = M.USU_CODTIP LEFT JOIN USU_T101CRI C ON C.USU_CODCRI = M.USU_CODCRI
LEFT JOIN USU_T017RVR V ON V.USU_CODRVR = M.USU_CODRVR LEFT JOIN E090REP R ON R.CODREP = M.USU_CODREP
LEFT JOIN E013AGP A ON A.CODEMP = M.USU_CODEMP AND A.CODAGP = M.USU_CODAGP LEFT JOIN E075PRO P ON P.CODEMP = M.USU_CODEMP AND P.CODPRO = M.USU_CODPRO
WHERE M.USU_CODEMP = 1"""),
    "dp08_opex_budget": _sql("USU_T650CUS USU_T650ORC E044CCU R910USU E043PCM", """
SELECT B.USU_CODEMP AS EMP, B.USU_MESANO AS COMP, B.USU_CODCCU AS CC, B.USU_CTADRE AS CDESP, B.USU_ORCMES AS ORCADO,
       CAST((SELECT SUM(A.USU_SALMES) FROM USU_T650CUS A WHERE A.USU_CODEMP = B.USU_CODEMP AND A.USU_MESANO = B.USU_MESANO
              AND A.USU_CODMPC = B.USU_CODMPC AND A.USU_CTADRE = B.USU_CTADRE AND A.USU_CODCCU = B.USU_CODCCU) AS DOUBLE) AS REALIZADO,
       C.DESCCU AS CCUSTO, C.TIPCCU AS TPCC, E.DESCTA AS DESPESA, CASE WHEN C.TIPCCU IN (1, 2) THEN 'Produtivo' ELSE 'Não Produtivo' END AS PROD,
       C.USU_CODRES AS CODDONO, O.NOMCOM AS DONO, 'Q' || quarter(B.USU_MESANO) AS QUARTER, C.USU_CODCOR AS CODCOORD, K.NOMCOM AS COORD
FROM USU_T650ORC B LEFT JOIN E044CCU C ON C.CODEMP = B.USU_CODEMP AND C.CODCCU = B.USU_CODCCU
LEFT JOIN R910USU O ON O.CODENT = C.USU_CODRES LEFT JOIN R910USU K ON K.CODENT = C.USU_CODCOR
LEFT JOIN E043PCM E ON E.CTARED = B.USU_CTADRE AND E.CODMPC = B.USU_CODMPC
WHERE B.USU_CODEMP IN (1, 50) AND B.USU_CODMPC = '801'"""),
    "dp09_traceability": _sql("E140IPV E140NFV E085CLI E090REP E026RAM E075PRO E120IPD USU_T140QRC USU_VZRASLAU", """
SELECT I.NUMNFV, I.NUMPED, I.CODPRO, P.DESPRO, CAST(I.QTDFAT AS DOUBLE) AS QTDFAT, N.CODCLI, N.CODREP, N.DATEMI, C.NOMCLI, C.APECLI, C.TIPCLI, C.SIGUFS, C.CIDCLI, C.CODRAM,
       R.NOMREP, R.APEREP, R.TIPREP, R.USU_CODRAM AS CANREP, A.DESRAM, Q.USU_CODBAR AS CODBAR, Q.USU_DATGER AS DATGER, V.CODFOR, V.NOMFOR, V.NUMOCP,
       V.USU_NUMINV AS NUMINV, V.NUMNFC, V.DATEMIOCP AS DATOCP, V.USU_DATEMB AS DATEMB, V.DATEMINFC, V.DATENTNFC, CAST(NULL AS VARCHAR) AS MIX, CAST(NULL AS VARCHAR) AS ORIGEM
FROM E140IPV I JOIN E140NFV N ON N.NUMNFV = I.NUMNFV JOIN E085CLI C ON C.CODCLI = N.CODCLI JOIN E090REP R ON R.CODREP = N.CODREP JOIN E026RAM A ON A.CODRAM = R.USU_CODRAM
JOIN E075PRO P ON P.CODPRO = I.CODPRO JOIN E120IPD D ON D.NUMPED = I.NUMPED AND D.SEQIPD = I.SEQIPD
JOIN USU_T140QRC Q ON Q.USU_NUMNFV = I.NUMNFV AND Q.USU_SEQIPV = I.SEQIPV LEFT JOIN USU_VZRASLAU V ON V.USU_CODBAR = Q.USU_CODBAR
WHERE I.CODDEP IN ('EXP', 'E-COMMERCE') AND CAST(N.DATEMI AS DATE) >= DATE '2000-01-01' AND CAST(Q.USU_DATGER AS DATE) >= DATE '2000-01-01'
  AND D.TNSPRO IN ('90100', '90101', '90120', '90170', '90171')"""),
    "dp10_production_products": _sql("E075PRO E075DER E013AGP E012FAM LEGACY", """
, j AS (
    SELECT P.CODEMP, P.CODPRO, P.DESPRO, D.CODDER, P.CODFAM, F.DESFAM, P.UNIMED, P.TIPPRO, P.CODORI, P.CODAGE, D.CODAGT, A.DESAGP, P.SITPRO, D.CURABC,
           P.DEPPAD, P.USU_INDFDL, CASE WHEN NULLIF(trim(D.CODDER), '') = NULLIF(trim(L.CODDER), '') THEN 0 ELSE 1 END AS pri
    FROM E075PRO P LEFT JOIN E075DER D ON D.CODEMP = P.CODEMP AND D.CODPRO = P.CODPRO LEFT JOIN E013AGP A ON A.CODEMP = P.CODEMP AND A.CODAGP = D.CODAGT
    LEFT JOIN E012FAM F ON F.CODEMP = P.CODEMP AND F.CODFAM = P.CODFAM LEFT JOIN LEGACY L ON L.CODEMP = P.CODEMP AND L.CODPRO = P.CODPRO
    WHERE P.CODEMP = 1 AND P.CODORI <> 'SER'),
r AS (SELECT *, row_number() OVER (PARTITION BY CODPRO ORDER BY pri, CODDER NULLS LAST, CODAGT NULLS FIRST, DESAGP NULLS FIRST, CURABC NULLS FIRST) AS n FROM j)
SELECT * EXCLUDE (pri, n) FROM r WHERE n = 1"""),
    "dp11_cost_centres": _sql("E720OPR E725CRE E044CCU E093ETG", """
SELECT COALESCE(O.CODCCU, ' ') AS CODCCU, C.DESCCU, C.ABRCCU, C.CCUPAI, COALESCE(O.CODETG, ' ') AS CODETG, G.DESETG, G.ABRETG,
       COALESCE(O.CODCRE, ' ') AS CODCRE, R.DESCRE, R.ABRCRE, COALESCE(O.CODOPR, ' ') AS CODOPR, O.DESOPR, O.ABROPR, O.UNICRE, O.MOVORP
FROM E720OPR O LEFT JOIN E044CCU C ON C.CODEMP = O.CODEMP AND C.CODCCU = O.CODCCU LEFT JOIN E093ETG G ON G.CODEMP = O.CODEMP AND G.CODETG = O.CODETG
LEFT JOIN E725CRE R ON R.CODEMP = O.CODEMP AND R.CODCRE = O.CODCRE
UNION ALL
SELECT COALESCE(R.CODCCU, ' '), C.DESCCU, C.ABRCCU, C.CCUPAI, '0', ' ', ' ', COALESCE(R.CODCRE, ' '), R.DESCRE, R.ABRCRE,
       COALESCE(O.CODOPR, ' '), O.DESOPR, O.ABROPR, O.UNICRE, O.MOVORP
FROM E725CRE R LEFT JOIN E044CCU C ON C.CODEMP = R.CODEMP AND C.CODCCU = R.CODCCU LEFT JOIN E720OPR O ON O.CODEMP = R.CODEMP AND O.CODCRE = R.CODCRE
WHERE R.CODCRE IN ('3', '7', '900')"""),
    "dp12_standard_cost": _sheet_sql("DIM_CUSTO_PADRAO_PRODUCAO", """
SELECT PRODUTO, TRY_CAST(CODEMPRESA AS BIGINT) AS CODEMPRESA, TRY_CAST(replace(CUSTO_PADRAO, ',', '.') AS DOUBLE) AS CUSTO_PADRAO
FROM s WHERE trim(PRODUTO) <> '' AND TRY_CAST(replace(CUSTO_PADRAO, ',', '.') AS DOUBLE) IS NOT NULL"""),
    "dp13_stoppages": _sql("E930MPR E018MTV E093ETG E044CCU", """
SELECT S.CODETG, S.CODCRE, G.CODCCU, C.DESCCU, S.IDEBEM, S.DATMPR, S.CODMTV, M.DESMTV, M.ABRMTV, M.USU_TIPMTV AS TIPMTV,
       CASE WHEN M.USU_TIPMTV = 1 THEN 'Programado' ELSE 'Nao Programado' END AS DESTIP, M.USU_CLAMTV AS CLAMTV,
       CASE M.USU_CLAMTV WHEN 1 THEN 'Operacional' WHEN 2 THEN 'Manutencao' WHEN 3 THEN 'Utilidades' WHEN 4 THEN 'TI' WHEN 5 THEN 'Externo'
            ELSE '*** VAZIO ***' END AS DESCLA,
       S.SEQMPR, S.HORINI AS HORCHA, round(S.HORINI / 60.0, 2) AS HORINI, round(S.HORFIM / 60.0, 2) AS HORFIM
FROM E930MPR S LEFT JOIN E018MTV M ON M.CODEMP = S.CODEMP AND M.CODMTV = S.CODMTV LEFT JOIN E093ETG G ON G.CODEMP = S.CODEMP AND G.CODETG = S.CODETG
LEFT JOIN E044CCU C ON C.CODEMP = S.CODEMP AND C.CODCCU = G.CODCCU
WHERE S.DATMPR > TIMESTAMP '1999-06-15 00:00:00'"""),
    "dp14_budget_entries": _sql("E626ORC E047NTG E621MTC", """
SELECT B.CODEMP, B.NUMMTC, M.TIPMTC, CASE M.TIPMTC WHEN '31' THEN 'REALIZADO' ELSE 'ORCADO' END AS TIPORC, M.CODMTC, M.DESMTC, B.CODCCU, B.CODNTG,
       N.DESNTG, M.DATINI, M.DATFIM
FROM E626ORC B JOIN E047NTG N ON N.CODEMP = B.CODEMP AND N.CODNTG = B.CODNTG JOIN E621MTC M ON M.CODEMP = B.CODEMP AND M.NUMMTC = B.NUMMTC
WHERE B.CODCCU > '4000' AND B.CODCCU < '4300' AND B.NUMMTC > 1600 AND M.DATINI >= DATE '1999-06-15'"""),
    "dp15_utilisation_target": _sheet_sql("FAT_UTILIZACAO_META_PRODUCAO", """
SELECT CAST(DATA AS TIMESTAMP) AS DATA, trim(CD_CENTROCUSTO) AS CD_CENTROCUSTO, COALESCE(TRY_CAST(MIN_DIA AS DOUBLE), 0) AS MIN_DIA,
       COALESCE(TRY_CAST(DIAS_UTEIS AS DOUBLE), 0) AS DIAS_UTEIS, COALESCE(TRY_CAST(LIMITE_SUPERIOR AS DOUBLE), 0) AS LIMITE_SUPERIOR, NOTA
FROM s WHERE CD_CENTROCUSTO IS NOT NULL AND CAST(DATA AS TIMESTAMP) >= TIMESTAMP '1999-06-15 00:00:00'"""),
    "dp17_rma_index": _sheet_sql("DIM_INDICE_RMA", "SELECT ID, NOME FROM s WHERE ID IS NOT NULL"),
    "dp18_defect_reclassification": _sheet_sql("DIM_RECLASSIF_DEFEITOS", """
SELECT trim(PRODUTO) AS PRODUTO, trim("CÓDIGO") AS "CÓDIGO", trim(NOVA) AS NOVA, trim(PRODUTO) || '|' || trim("CÓDIGO") AS PROD_COD_DEF
FROM s WHERE trim(PRODUTO) NOT IN ('', 'nan') AND lower(trim("CÓDIGO")) NOT IN ('', 'nan')"""),
    "dp19_product_reclassification": _sheet_sql("DIM_RECLASSIF_PRODUTOS", """
SELECT trim("CÓD. PRODUTO") AS CD_PRODUTO, trim("NOVO CÓDIGO") AS CD_PRODUTO_NOVO, trim("SITUAÇÃO") AS DS_SIT_INDICADOR, trim(OUTRA) AS OUTRA
FROM s WHERE trim("CÓD. PRODUTO") <> ''"""),
    "dp20_rma_sales": _sql("E140NFV E140IPV E140IDE E001TNS", """
, m AS (
    SELECT CAST(date_trunc('month', T0.DATEMI) AS DATE) AS MES, T1.CODPRO, SUM(T1.QTDFAT) AS q
    FROM E140NFV T0 JOIN E140IPV T1 ON T1.NUMNFV = T0.NUMNFV JOIN E140IDE T2 ON T2.NUMNFV = T0.NUMNFV JOIN E001TNS T3 ON T3.CODTNS = T1.TNSPRO
    WHERE T0.SITNFV = '2' AND T0.TIPNFS IN (1, 9) AND T2.SITDOE = 3 AND T3.VENFAT = 'S' GROUP BY 1, 2)
SELECT 1 AS TIPREG, last_day(a.MES) AS DATREF, last_day(CAST(a.MES - INTERVAL 1 MONTH AS DATE)) AS DATFIM, CAST(a.MES - INTERVAL 6 MONTH AS DATE) AS DATINI,
       CAST(1 AS BIGINT) AS CODEMP, a.CODPRO,
       CAST((SELECT SUM(b.q) FROM m b WHERE b.CODPRO = a.CODPRO AND b.MES BETWEEN a.MES - INTERVAL 6 MONTH AND a.MES - INTERVAL 1 MONTH) AS DOUBLE) AS QTDMED,
       month(a.MES) || '|' || year(a.MES) || '|' || a.CODPRO AS VENDA_MES_ANO_PRODUTO
FROM m a WHERE a.MES >= DATE '2000-01-01'"""),
}
