"""Commercial products: DP-01 .. DP-07.

Look-ups are plain left joins on aliased frames; Catalyst/AQE choose the join
strategy from sizes (dimensions broadcast when small).  Aggregates run before
joins wherever the source ran a correlated sub-query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions import exprs as X
from ...operators import blocks as B
from .common import Bronze, ProductParams, c, on

# ---------------------------------------------------------------------------
# Fixed values (business codes of the source system)
# ---------------------------------------------------------------------------
OPEN_ORDER_SITUATIONS = ("1", "2")
OPEN_ORDER_TRANSACTIONS = ("90100", "90101", "90120", "90170")
SALE_NOTE_TYPES = (1, 9)
CUSTOMER_NOTE_TYPES = (1,)
ISSUED_NOTE = "2"
AUTHORISED_DOC = 3
BILLED = "S"
RETURN_NOTE = "2"
RETURN_PURPOSES = ("D", "A")
RETURN_NATURES_SALE = ("1201", "2201", "1202", "2202", "1203", "2203", "1503", "2503",
                       "1410", "2410", "1411", "2411")
RETURN_ENTRY_TYPES_SALE = ("2", "3")
RETURN_NATURES_CONSIGN = ("1603", "2603")
RETURN_ENTRY_TYPES_CONSIGN = ("9", "10")
NOT_IDENTIFIED = "NÃO IDENTIFICADO"
NO_GROUP = "SEM GRUPO"


def _status(col, active_code, yes, no):
    return F.when(col == active_code, yes).otherwise(no)


def _doc(doc, ptype):
    return F.when(ptype == "F", X.lpad_num(doc, 11)).otherwise(X.lpad_num(doc, 14))


# ---------------------------------------------------------------------------
# DP-01 payment terms
# ---------------------------------------------------------------------------
def payment_terms(bronze: Bronze, p: ProductParams) -> DataFrame:
    cp = bronze("E028CPG").where(F.col("CODEMP") == p.company)
    desc = X.trim_upper("DESCPG")
    return cp.select(
        "CODCPG", desc.alias("DESCPG"),
        X.oconcat("PRZMED", F.lit(" PM - "), desc).alias("DESCPGTO"),
        F.col("ABRCPG").alias("ABREVCPG"), "PRZMED", F.col("QTDPAR").alias("QTDPARC"), "SITCPG",
        _status(F.col("SITCPG"), "A", "ATIVA", "INATIVA").alias("SITCPG_DESC"),
        F.date_format("DATGER", "dd/MM/yyyy").alias("DATCAD"),
        F.date_format("DATATU", "dd/MM/yyyy").alias("ULTATU"))


# ---------------------------------------------------------------------------
# DP-02 product variants
# ---------------------------------------------------------------------------
def product_variants(bronze: Bronze, p: ProductParams) -> DataFrame:
    d = bronze("E075DER").alias("D")
    pro = bronze("E075PRO").alias("P")
    agp = bronze("E013AGP").alias("M")
    clf = bronze("E022CLF").alias("N")
    j = (d.join(pro, on("D", "P", "CODEMP", "CODPRO"), "left")
          .join(agp, (c("P", "CODEMP") == c("M", "CODEMP")) & (c("D", "CODAGT") == c("M", "CODAGP")), "left")
          .join(clf, c("P", "CODCLF") == c("N", "CODCLF"), "left")
          .where(c("D", "CODEMP") == p.company))
    der = c("D", "CODDER")
    key = F.when(der.isNull() | (F.trim(der) == ""), c("D", "CODPRO")).otherwise(
        X.oconcat(c("D", "CODPRO"), F.lit("-"), der))
    return j.select(
        c("D", "CODAGT").alias("CATEGORIAID"), X.blank_to_null(c("M", "DESAGP")).alias("CATEGORIA"),
        key.alias("CHAVE_ITEM"), c("P", "CODPRO").alias("CODITEM"),
        X.trim_upper(c("P", "DESPRO")).alias("DESCITEM"), c("N", "CLAFIS").alias("CODNCM"),
        c("D", "CODGTN").alias("CODEAN"), c("N", "CODCES").alias("CODCEST"),
        (c("P", "PERIPI") / 100).alias("PERIPI"),
        _status(c("D", "SITDER"), "A", "ATIVO", "INATIVO").alias("SITITEM"),
        c("P", "USU_INDFDL").alias("FORALINHA"), c("D", "COMDER").alias("COMPRIMENTO"),
        c("D", "ALTDER").alias("ALTURA"), c("D", "LARDER").alias("LARGURA"),
        c("D", "PESBRU").alias("PESOBRUTO"), c("D", "PESLIQ").alias("PESOLIQ"))


# ---------------------------------------------------------------------------
# DP-03 sales representatives
# ---------------------------------------------------------------------------
REP_TYPES = {"1": "VENDEDOR", "2": "RCA", "3": "B2C"}


def sales_reps(bronze: Bronze, p: ProductParams) -> DataFrame:
    r = bronze("E090REP").alias("R")
    ram = bronze("E026RAM").alias("RAM")
    reg = bronze("USU_T017RVR").alias("REG")
    j = (r.join(ram, c("R", "USU_CODRAM") == c("RAM", "CODRAM"), "left")
          .join(reg, c("R", "USU_CODRVR") == c("REG", "USU_CODRVR"), "left"))
    tip = F.when(F.lit(False), None)
    for k, v in REP_TYPES.items():
        tip = tip.when(c("R", "USU_TIPREP") == k, v)
    return j.select(
        c("R", "CODREP").alias("CODREP"), _doc(c("R", "CGCCPF"), c("R", "TIPREP")).alias("DOCREP"),
        X.trim_upper(c("R", "NOMREP")).alias("NOMEREP"), X.trim_upper(c("R", "APEREP")).alias("APEREP"),
        tip.otherwise("OUTROS").alias("TIPOREP"),
        _status(c("R", "SITWMW"), "A", "ATIVO", "INATIVO").alias("SITREP"),
        F.upper(c("R", "USU_CODRAM")).alias("CODRAMO"), X.trim_upper(c("RAM", "DESRAM")).alias("RAMO"),
        X.trim_upper(c("R", "CIDREP")).alias("CIDADE"), X.trim_upper(c("R", "SIGUFS")).alias("ESTADO"),
        X.digits_only(c("R", "FONREP")).alias("TELEFONE"), X.trim_lower(c("R", "INTNET")).alias("EMAIL"),
        c("R", "USU_CODRVR").alias("ID_REGIONAL"), X.trim_upper(c("REG", "USU_NOMRVR")).alias("NOME_REGIONAL"),
        X.day(c("R", "DATCAD")).alias("DT_CADASTRO"))


# ---------------------------------------------------------------------------
# DP-04 regions (override tables are inputs: data, not code)
# ---------------------------------------------------------------------------
def regions(bronze: Bronze, p: ProductParams, by_region: DataFrame | None = None,
            by_login: DataFrame | None = None) -> DataFrame:
    """``by_region`` (ID_REGIONAL, RESPONSAVEL) wins over ``by_login`` (LOGIN,
    RESPONSAVEL), which wins over the coordinator's login turned into a name."""
    spark = bronze("USU_T017RVR").sparkSession
    by_region = by_region if by_region is not None else spark.createDataFrame([], "ID_REGIONAL long, RESPONSAVEL string")
    by_login = by_login if by_login is not None else spark.createDataFrame([], "LOGIN string, RESPONSAVEL string")
    r = bronze("USU_T017RVR").alias("R")
    coord = bronze("R999USU").alias("COORD")
    assist = bronze("R999USU").alias("ASSIST")
    orr = by_region.alias("ORR")
    orl = by_login.alias("ORL")
    j = (r.join(coord, c("R", "USU_USUCOR") == c("COORD", "CODUSU"), "left")
          .join(assist, c("R", "USU_USUASS") == c("ASSIST", "CODUSU"), "left")
          .join(orr, c("ORR", "ID_REGIONAL") == c("R", "USU_CODRVR"), "left")
          .join(orl, c("ORL", "LOGIN") == F.lower(c("COORD", "NOMUSU")), "left"))

    def person(col):
        return F.when(col.isNull(), F.lit(NOT_IDENTIFIED)).otherwise(F.upper(X.dots_to_spaces(col)))

    return j.select(
        c("R", "USU_CODRVR").alias("ID_REGIONAL"), F.upper(c("R", "USU_NOMRVR")).alias("REGIONAL"),
        F.upper(X.oconcat(F.lit("R"), X.fm00(c("R", "USU_CODRVR")), F.lit(" - "), c("R", "USU_NOMRVR")))
        .alias("NOME_REGIONAL"),
        F.coalesce(c("ORR", "RESPONSAVEL"), c("ORL", "RESPONSAVEL"), person(c("COORD", "NOMUSU")))
        .alias("RESPONSAVEL"),
        person(c("ASSIST", "NOMUSU")).alias("ASSISTENTE"), c("R", "USU_DATGER").alias("DT_CADASTRO"))


# ---------------------------------------------------------------------------
# DP-05 sales targets
# ---------------------------------------------------------------------------
def targets(bronze: Bronze, p: ProductParams) -> DataFrame:
    m = bronze("USU_T101MET").alias("M")
    tip = bronze("USU_T101TIP").alias("TIP")
    cri = bronze("USU_T101CRI").alias("CRI")
    rvr = bronze("USU_T017RVR").alias("RVR")
    rep = bronze("E090REP").alias("REP")
    agp = bronze("E013AGP").alias("AGP")
    pro = bronze("E075PRO").alias("PRO")
    j = (m.join(tip, c("M", "USU_CODTIP") == c("TIP", "USU_CODTIP"), "left")
          .join(cri, c("M", "USU_CODCRI") == c("CRI", "USU_CODCRI"), "left")
          .join(rvr, c("M", "USU_CODRVR") == c("RVR", "USU_CODRVR"), "left")
          .join(rep, c("M", "USU_CODREP") == c("REP", "CODREP"), "left")
          .join(agp, (c("M", "USU_CODEMP") == c("AGP", "CODEMP")) & (c("M", "USU_CODAGP") == c("AGP", "CODAGP")), "left")
          .join(pro, (c("M", "USU_CODEMP") == c("PRO", "CODEMP")) & (c("M", "USU_CODPRO") == c("PRO", "CODPRO")), "left")
          .where(c("M", "USU_CODEMP") == p.company))
    uni, dire = c("CRI", "USU_UNICRI"), c("CRI", "USU_DIRCRI")
    return j.select(
        c("M", "USU_CODEMP").alias("CODEMP"), c("M", "USU_MESANO").alias("MESANO"),
        c("M", "USU_CODTIP").alias("CODTIP"), c("M", "USU_SEQREG").alias("SEQREG"),
        X.trim_upper(c("TIP", "USU_DESTIP")).alias("DESC_TIPO"),
        c("M", "USU_CODCRI").alias("CODCRI"), X.trim_upper(c("CRI", "USU_DESCRI")).alias("DESC_CRITERIO"),
        uni.alias("UNICRI"),
        F.when(uni == 1, "QUANTIDADE").when(uni == 2, "VALOR").when(uni == 3, "PERCENTUAL")
        .otherwise("NÃO DEFINIDO").alias("DESC_UNICRI"),
        dire.alias("DIRCRI"),
        F.when(dire == 1, "MAXIMIZAR").when(dire == 2, "MINIMIZAR").otherwise("NÃO DEFINIDO").alias("DESC_DIRCRI"),
        c("M", "USU_CODRVR").alias("CODRVR"), X.trim_upper(c("RVR", "USU_NOMRVR")).alias("NOME_REGIONAL"),
        c("M", "USU_CODREP").alias("CODREP"), X.trim_upper(c("REP", "NOMREP")).alias("NOME_REP"),
        c("M", "USU_CODAGP").alias("CODAGP"), X.trim_upper(c("AGP", "DESAGP")).alias("DESC_MIX"),
        c("M", "USU_CODPRO").alias("CODPRO"), X.trim_upper(c("PRO", "DESPRO")).alias("DESC_PRODUTO"),
        c("M", "USU_VLRMET").alias("VLR_META"), c("M", "USU_PESCRI").alias("PESO_CRITERIO"),
        c("M", "USU_DATGER").alias("DT_CRIACAO"), X.trim_upper(c("M", "USU_NOMUSU")).alias("USUARIO"))


# ---------------------------------------------------------------------------
# DP-06 customers
# ---------------------------------------------------------------------------
def customer_sales(bronze: Bronze, p: ProductParams) -> DataFrame:
    """Billed customer notes with the customer's group base (COD_CLI_BASE)."""
    nf = bronze("E140NFV").alias("NF")
    t = bronze("E001TNS").alias("T")
    i = bronze("E140IDE").alias("I")
    cli = bronze("E085CLI").alias("C")
    g = bronze("E069GRE").alias("G")
    j = (nf.join(t, (c("NF", "CODEMP") == c("T", "CODEMP")) & (c("NF", "TNSPRO") == c("T", "CODTNS")))
           .join(i, (c("NF", "CODEMP") == c("I", "CODEMP")) & (c("NF", "NUMNFV") == c("I", "NUMNFV")))
           .join(cli, c("NF", "CODCLI") == c("C", "CODCLI"))
           .join(g, c("C", "CODGRE") == c("G", "CODGRE"), "left")
           .where((c("NF", "CODEMP") == p.company) & c("NF", "TIPNFS").isin(*CUSTOMER_NOTE_TYPES)
                  & (c("NF", "SITNFV") == ISSUED_NOTE) & (c("T", "VENFAT") == BILLED)
                  & (c("I", "SITDOE") == AUTHORISED_DOC)))
    return j.select(F.coalesce(c("G", "CLIBAS"), c("C", "CODCLI")).alias("COD_CLI_BASE"),
                    c("NF", "DATEMI").alias("DATEMI"), c("NF", "NUMNFV").alias("NUMNFV"),
                    c("NF", "CODREP").alias("CODREP"))


def customers(bronze: Bronze, p: ProductParams) -> DataFrame:
    sales = customer_sales(bronze, p)
    nth = B.nth_event(sales, "COD_CLI_BASE", "DATEMI", 4,
                      ["DT_PRIMCOMPRA_BASE", "DT_SEGCOMPRA_BASE", "DT_TERCOMPRA_BASE", "DT_QUACOMPRA_BASE"],
                      "DT_ULTCOMPRA_BASE", "_N_DAYS")
    reps = B.first_last_by(sales, "COD_CLI_BASE", ["DATEMI", "NUMNFV"], "CODREP",
                           "CODREP_ABERTURA", "CODREP_ULTVENDA")
    v = nth.join(reps, "COD_CLI_BASE", "full").alias("V")

    C = bronze("E085CLI").alias("C")
    j = (C.join(bronze("E069GRE").alias("G"), c("C", "CODGRE") == c("G", "CODGRE"), "left")
          .join(bronze("E085CLI").alias("CB"),
                F.coalesce(c("G", "CLIBAS"), c("C", "CODCLI")) == c("CB", "CODCLI"), "left")
          .join(bronze("E026RAM").alias("RAM"), c("C", "CODRAM") == c("RAM", "CODRAM"), "left")
          .join(bronze("E085HCL").alias("H"), (c("H", "CODCLI") == c("C", "CODCLI"))
                & (c("H", "CODEMP") == p.company) & (c("H", "CODFIL") == p.branch), "left")
          .join(bronze("USU_T017RVR").alias("REG"), c("C", "USU_CODRVR") == c("REG", "USU_CODRVR"), "left")
          .join(bronze("USU_TPCRCPC").alias("GRA"), c("C", "CODCLI") == c("GRA", "USU_CODCLI"), "left")
          .join(bronze("USU_TPCRCDG").alias("DGRA"), c("GRA", "USU_CODGRA") == c("DGRA", "USU_CODGRA"), "left")
          .join(bronze("E066FPG").alias("FPG"), on("FPG", "H", "CODEMP", "CODFPG"), "left")
          .join(bronze("E028CPG").alias("CPG"), on("CPG", "H", "CODEMP", "CODCPG"), "left")
          .join(bronze("USU_TPCAPFC").alias("PERFIL"), c("PERFIL", "USU_CODPFC") == c("H", "USU_CODPFC"), "left")
          .join(bronze("USU_TPCAMNC").alias("MODNEG"), c("MODNEG", "USU_CODMNC") == c("H", "USU_CODMNC"), "left")
          .join(bronze("E073TRA").alias("TRA"), c("H", "CODTRA") == c("TRA", "CODTRA"), "left")
          .join(v, F.coalesce(c("G", "CLIBAS"), c("C", "CODCLI")) == c("V", "COD_CLI_BASE"), "left")
          .join(bronze("E090REP").alias("R_PRI"), c("V", "CODREP_ABERTURA") == c("R_PRI", "CODREP"), "left")
          .join(bronze("E090REP").alias("R_ULT"), c("V", "CODREP_ULTVENDA") == c("R_ULT", "CODREP"), "left")
          .join(bronze("E090REP").alias("R_ATU"), c("H", "CODREP") == c("R_ATU", "CODREP"), "left"))
    cep = X.lpad_num(c("C", "CEPCLI"), 8)
    address = F.trim(F.upper(
        X.oconcat(c("C", "ENDCLI"), F.lit(", "), c("C", "NENCLI"), F.lit(" - "), c("C", "BAICLI"), F.lit(", "),
                  c("C", "CIDCLI"), F.lit(", "), c("C", "SIGUFS"), F.lit(", "), cep)))
    if not p.faithful_address:
        comp = X.blank_to_null(c("C", "CPLEND"))
        with_comp = F.trim(F.upper(X.oconcat(
            c("C", "ENDCLI"), F.lit(", "), c("C", "NENCLI"), F.lit(" ("), c("C", "CPLEND"), F.lit(") - "),
            c("C", "BAICLI"), F.lit(", "), c("C", "CIDCLI"), F.lit(", "), c("C", "SIGUFS"), F.lit(", "), cep)))
        address = F.when(comp.isNotNull(), with_comp).otherwise(address)
    return j.select(
        F.coalesce(c("G", "CODGRE"), F.lit("0")).alias("COD_GRUPO"),
        F.coalesce(X.trim_upper(c("G", "NOMGRE")), F.lit(NO_GROUP)).alias("NOME_GRUPO"),
        F.coalesce(c("G", "CLIBAS"), c("C", "CODCLI")).alias("CODCLI_BASE"),
        _doc(c("CB", "CGCCPF"), c("CB", "TIPCLI")).alias("DOC_BASE"),
        X.trim_upper(c("CB", "NOMCLI")).alias("NOME_BASE"), c("CB", "SIGUFS").alias("UF_BASE"),
        X.trim_upper(c("CB", "CIDCLI")).alias("CIDADE_BASE"),
        c("V", "DT_PRIMCOMPRA_BASE"), c("V", "DT_SEGCOMPRA_BASE"), c("V", "DT_TERCOMPRA_BASE"),
        c("V", "DT_QUACOMPRA_BASE"),
        c("V", "CODREP_ABERTURA"), X.trim_upper(c("R_PRI", "NOMREP")).alias("REP_ABERTURA"),
        c("V", "DT_ULTCOMPRA_BASE"),
        c("V", "CODREP_ULTVENDA"), X.trim_upper(c("R_ULT", "NOMREP")).alias("REP_ULT_VENDA"),
        c("C", "USU_CODRVR").alias("COD_REGIONAL"), X.trim_upper(c("REG", "USU_NOMRVR")).alias("NOME_REGIONAL"),
        c("H", "CODREP").alias("CODREP_ATUAL"), X.trim_upper(c("R_ATU", "NOMREP")).alias("NOME_REP_ATUAL"),
        c("C", "CODCLI").alias("COD_CLIENTE"), _doc(c("C", "CGCCPF"), c("C", "TIPCLI")).alias("DOC_CLIENTE"),
        X.trim_upper(c("C", "NOMCLI")).alias("NOME_CLIENTE"),
        F.when(c("C", "TIPCLI") == "F", "PF").otherwise("PJ").alias("TIPO_CLIENTE"),
        _status(c("C", "SITCLI"), "A", "ATIVO", "INATIVO").alias("STATUS_CLIENTE"),
        c("C", "CODRAM").alias("COD_RAMO_ATIVIDADE"), X.trim_upper(c("RAM", "DESRAM")).alias("DESC_RAMO_ATIVIDADE"),
        X.day(c("C", "DATCAD")).alias("DT_CADASTRO"), X.day(c("C", "DATATU")).alias("DT_ULTIMA_ATUALIZACAO"),
        c("MODNEG", "USU_CODMNC").alias("COD_MOD_NEGOCIO"),
        X.trim_upper(c("MODNEG", "USU_DSCMNC")).alias("DESC_MOD_NEGOCIO"),
        c("PERFIL", "USU_CODPFC").alias("COD_PERFIL"), X.trim_upper(c("PERFIL", "USU_DSCPFC")).alias("DESC_PERFIL"),
        c("GRA", "USU_CODGRA").alias("COD_GRADUACAO"), X.trim_upper(c("DGRA", "USU_DESGRA")).alias("DESC_GRADUACAO"),
        c("H", "CONFIN").alias("CONSUMIDOR_FINAL"), c("C", "CLICON").alias("CONTRIBUINTE_ICMS"),
        c("H", "LIMAPR").alias("LIMITE_APROVADO"), X.day(c("H", "DATLIM")).alias("DT_LIMITE_CREDITO"),
        c("H", "VLRLIM").alias("VLR_LIMITE_CREDITO"),
        c("CPG", "CODCPG").alias("COD_COND_PGTO"), X.trim_upper(c("CPG", "DESCPG")).alias("DESC_COND_PGTO"),
        c("FPG", "CODFPG").alias("COD_FORMA_PGTO"), X.trim_upper(c("FPG", "DESFPG")).alias("DESC_FORMA_PGTO"),
        X.trim_upper(c("C", "ENDCLI")).alias("ENDERECO"), X.trim_upper(c("C", "NENCLI")).alias("NUMERO"),
        X.trim_upper(c("C", "CPLEND")).alias("COMPLEMENTO"), X.trim_upper(c("C", "BAICLI")).alias("BAIRRO"),
        cep.alias("CEP"), X.trim_upper(c("C", "CIDCLI")).alias("CIDADE_CLIENTE"), c("C", "SIGUFS").alias("UF_CLIENTE"),
        address.alias("ENDERECO_COMPLETO"),
        X.digits_only(c("C", "FONCLI")).alias("TELEFONE"), X.digits_only(c("C", "FONCL2")).alias("TELEFONE2"),
        X.trim_lower(c("C", "INTNET")).alias("EMAIL"),
        c("H", "CODTRA").alias("COD_TRANSPORTADORA"), X.trim_upper(c("TRA", "NOMTRA")).alias("NOME_TRANSPORTADORA"))


# ---------------------------------------------------------------------------
# DP-07 billing lines (four blocks)
# ---------------------------------------------------------------------------
BILLING_COLUMNS = [
    ("DATAREF", "date"), ("TIPOREG", "string"), ("VENDA", "int"), ("CODFILIAL", "bigint"),
    ("CODCLIBASE", "bigint"), ("CODCLI", "bigint"), ("NUMPED", "bigint"), ("NUMNFV", "bigint"),
    ("NUMNFD", "bigint"), ("CHAVE_ITEM", "string"), ("CODDEP", "string"), ("CODTRANSP", "string"),
    ("CODCPG", "string"), ("CODFPG", "string"), ("QTDITEM", "decimal(38,10)"), ("PRECOUNIT", "decimal(38,10)"),
    ("VLR_LIQ", "decimal(38,10)"), ("PERC_OFF", "decimal(38,10)"), ("VLR_OFF", "decimal(38,10)"),
    ("VLR_IPI", "decimal(38,10)"), ("VLR_ICMS", "decimal(38,10)"), ("VLR_ST", "decimal(38,10)"),
    ("VLR_FUNDPOB", "decimal(38,10)"), ("VLR_OUT", "decimal(38,10)"), ("VLR_SLI", "decimal(38,10)"),
    ("VLRBRUTO_TOTAL", "decimal(38,10)"), ("VLRDESC_TOTAL", "decimal(38,10)"), ("MOTIVODEV", "string"),
    ("CODREP", "bigint"), ("CODREGREP", "string"), ("CODREGCLI", "string"),
    ("SEQIPD", "bigint"), ("SEQIPV", "bigint"), ("SEQISV", "bigint"), ("SEQIPC", "bigint"),
]


def _return_notes(bronze: Bronze, p: ProductParams) -> DataFrame:
    """Return notes from the cutoff on, each with its supplier, the customer that is the
    supplier, and that customer's history, group and representative: joined once a note."""
    n = bronze("E440NFC").where(
        (F.col("CODEMP") == p.company) & (F.col("SITNFC") == RETURN_NOTE) & F.col("TIPNFE").isin(*RETURN_ENTRY_TYPES_SALE, *RETURN_ENTRY_TYPES_CONSIGN)
        & (F.col("DATENT") >= F.lit(p.billing_cutoff).cast("timestamp_ntz")))
    supplier = (bronze("E095FOR").alias("F").join(bronze("E085CLI").alias("C"), c("F", "CODCLI") == c("C", "CODCLI"), "left")
                .join(bronze("E069GRE").alias("G"), c("C", "CODGRE") == c("G", "CODGRE"), "left")
                .select(c("F", "CODFOR").alias("F_CODFOR"), c("F", "CODCLI").alias("F_CODCLI"), c("C", "CODCLI").alias("C_CODCLI"),
                        c("C", "USU_CODRVR").alias("C_USU_CODRVR"), c("G", "CLIBAS").alias("G_CLIBAS")))
    history = (bronze("E085HCL").alias("H").join(bronze("E090REP").alias("R"), c("H", "CODREP") == c("R", "CODREP"), "left")
               .select(c("H", "CODEMP").alias("H_CODEMP"), c("H", "CODFIL").alias("H_CODFIL"), c("H", "CODCLI").alias("H_CODCLI"),
                       c("H", "CODREP").alias("H_CODREP"), c("R", "USU_CODRVR").alias("R_USU_CODRVR")))
    return (n.join(supplier, F.col("CODFOR") == F.col("F_CODFOR"), "left")
             .join(history, (F.col("CODEMP") == F.col("H_CODEMP")) & (F.col("CODFIL") == F.col("H_CODFIL"))
                   & (F.col("F_CODCLI") == F.col("H_CODCLI")), "left"))


def billing(bronze: Bronze, p: ProductParams) -> DataFrame:
    cut = F.lit(p.billing_cutoff).cast("timestamp_ntz")
    zero = F.lit(0)

    # -- open orders -------------------------------------------------------
    iped = bronze("E120IPD").alias("IPED")
    ped = bronze("E120PED").alias("P")
    a = (iped.join(ped, on("IPED", "P", "CODEMP", "CODFIL", "NUMPED"), "left")
            .where((c("IPED", "CODEMP") == p.company) & c("P", "SITPED").isin(*OPEN_ORDER_SITUATIONS)
                   & c("IPED", "TNSPRO").isin(*OPEN_ORDER_TRANSACTIONS) & (c("P", "DATPRV") >= cut)))
    i = "IPED"
    ped_blk = a.select(
        X.day(c("P", "DATPRV")).alias("DATAREF"), F.lit("PED").alias("TIPOREG"), zero.alias("VENDA"),
        c(i, "CODFIL").alias("CODFILIAL"), c("P", "USU_CLIBAS").alias("CODCLIBASE"), c("P", "CODCLI").alias("CODCLI"),
        c(i, "NUMPED").alias("NUMPED"), zero.alias("NUMNFV"), zero.alias("NUMNFD"),
        F.when(c(i, "CODDER") == X.BLANK, X.oconcat(c(i, "CODPRO"), F.lit("-")))
        .otherwise(X.oconcat(c(i, "CODPRO"), F.lit("-"), c(i, "CODDER"))).alias("CHAVE_ITEM"),
        c(i, "CODDEP").alias("CODDEP"), c("P", "CODTRA").alias("CODTRANSP"), c("P", "CODCPG").alias("CODCPG"),
        c("P", "CODFPG").alias("CODFPG"), c(i, "QTDABE").alias("QTDITEM"), c(i, "PREUNI").alias("PRECOUNIT"),
        c(i, "VLRLIQ").alias("VLR_LIQ"), c(i, "PEROFE").alias("PERC_OFF"), c(i, "VLROFE").alias("VLR_OFF"),
        c(i, "VLRIPI").alias("VLR_IPI"), c(i, "VLRICM").alias("VLR_ICMS"), c(i, "VLRICS").alias("VLR_ST"),
        c(i, "VSTFCP").alias("VLR_FUNDPOB"), c(i, "VLROUT").alias("VLR_OUT"),
        (c(i, "VLRLIQ") - (c(i, "VLRIPI") + c(i, "VLRICS") + c(i, "VSTFCP") + c(i, "VLROUT"))).alias("VLR_SLI"),
        (c(i, "QTDABE") * c(i, "PREUNI")).alias("VLRBRUTO_TOTAL"),
        (c(i, "QTDABE") * c(i, "VLROFE")).alias("VLRDESC_TOTAL"), F.lit("0").alias("MOTIVODEV"),
        c(i, "CODREP").alias("CODREP"), c("P", "USU_CODRVRREP").alias("CODREGREP"),
        c("P", "USU_CODRVRCLI").alias("CODREGCLI"), c(i, "SEQIPD").alias("SEQIPD"))

    # -- product sales -----------------------------------------------------
    ipv = bronze("E140IPV").alias("I")
    ide = bronze("E140IDE").alias("IDE")
    # the transaction codes are few and each holds many lines: they are broadcast, and first
    codes = bronze("E001TNS")
    tns = F.broadcast(codes.where(F.col("VENFAT") == BILLED)).alias("T")
    nfv = bronze("E140NFV").alias("N")
    pvd = bronze("E140PVD").alias("PV")
    sale_filter = ((c("N", "TIPNFS").isin(*SALE_NOTE_TYPES)) & (c("N", "SITNFV") == ISSUED_NOTE)
                   & (c("T", "VENFAT") == BILLED) & (c("IDE", "SITDOE") == AUTHORISED_DOC))
    b = (ipv.join(tns, (c("I", "CODEMP") == c("T", "CODEMP")) & (c("I", "TNSPRO") == c("T", "CODTNS")))
            .join(ide, on("I", "IDE", "CODEMP", "CODFIL", "NUMNFV"), "left")
            .join(nfv, on("I", "N", "CODEMP", "CODFIL", "NUMNFV"), "left")
            .join(pvd, on("I", "PV", "CODEMP", "CODFIL", "NUMNFV", "SEQIPV"), "left")
            .where((c("I", "CODEMP") == p.company) & sale_filter & (c("I", "DATGER") >= cut)))
    i = "I"
    common_note = [c("N", "CODTRA").alias("CODTRANSP"), c("N", "CODCPG").alias("CODCPG"),
                   c("N", "CODFPG").alias("CODFPG"), c("N", "CODREP").alias("CODREP"),
                   c("N", "USU_CODRVRREP").alias("CODREGREP"), c("N", "USU_CODRVRCLI").alias("CODREGCLI"),
                   c("N", "USU_CLIBAS").alias("CODCLIBASE"), c("N", "CODCLI").alias("CODCLI")]
    ven_blk = b.select(
        X.day(c(i, "DATGER")).alias("DATAREF"), F.lit("VENPRO").alias("TIPOREG"), F.lit(1).alias("VENDA"),
        c(i, "CODFIL").alias("CODFILIAL"), *common_note,
        c(i, "NUMPED").alias("NUMPED"), c(i, "NUMNFV").alias("NUMNFV"), zero.alias("NUMNFD"),
        F.when(c(i, "CODDER") == X.BLANK, c(i, "CODPRO"))
        .otherwise(X.oconcat(c(i, "CODPRO"), F.lit("-"), c(i, "CODDER"))).alias("CHAVE_ITEM"),
        c(i, "CODDEP").alias("CODDEP"), c(i, "QTDFAT").alias("QTDITEM"), c(i, "PREUNI").alias("PRECOUNIT"),
        c(i, "VLRLIQ").alias("VLR_LIQ"), c(i, "PEROFE").alias("PERC_OFF"), c(i, "VLROFE").alias("VLR_OFF"),
        c(i, "VLRIPI").alias("VLR_IPI"), c(i, "VLRICM").alias("VLR_ICMS"), c(i, "VLRICS").alias("VLR_ST"),
        c("PV", "VSTFCP").alias("VLR_FUNDPOB"), c(i, "VLROUT").alias("VLR_OUT"),
        (c(i, "VLRLIQ") - (c(i, "VLRIPI") + c(i, "VLRICS") + c("PV", "VSTFCP") + c(i, "VLROUT"))).alias("VLR_SLI"),
        (c(i, "QTDFAT") * c(i, "PREUNI")).alias("VLRBRUTO_TOTAL"),
        (c(i, "QTDFAT") * c(i, "VLROFE")).alias("VLRDESC_TOTAL"), F.lit("0").alias("MOTIVODEV"),
        c(i, "SEQIPV").alias("SEQIPV"))

    # -- service sales -----------------------------------------------------
    isv = bronze("E140ISV").alias("S")
    ide2 = bronze("E140IDE").alias("IDE")
    nfv2 = bronze("E140NFV").alias("N")
    pvd2 = bronze("E140PVD").alias("PV")
    s_ = (isv.join(tns, (c("S", "CODEMP") == c("T", "CODEMP")) & (c("S", "TNSSER") == c("T", "CODTNS")))
             .join(ide2, on("S", "IDE", "CODEMP", "CODFIL", "CODSNF", "NUMNFV"), "left")
             .join(nfv2, on("S", "N", "CODEMP", "CODFIL", "CODSNF", "NUMNFV"), "left")
             .join(pvd2, on("S", "PV", "CODEMP", "CODFIL", "NUMNFV", "SEQIPV"), "left")
             .where((c("S", "CODEMP") == p.company) & sale_filter & (c("S", "DATGER") >= cut)))
    i = "S"
    nz = lambda x: F.coalesce(x, F.lit(0))
    ser_blk = s_.select(
        X.day(c(i, "DATGER")).alias("DATAREF"), F.lit("VENSER").alias("TIPOREG"), F.lit(1).alias("VENDA"),
        c(i, "CODFIL").alias("CODFILIAL"), *common_note,
        c(i, "NUMPED").alias("NUMPED"), c(i, "NUMNFV").alias("NUMNFV"), zero.alias("NUMNFD"),
        c(i, "CODSER").alias("CHAVE_ITEM"), F.lit(None).cast("string").alias("CODDEP"),   # '' is NULL
        c(i, "QTDFAT").alias("QTDITEM"), c(i, "PREUNI").alias("PRECOUNIT"), c(i, "VLRLIQ").alias("VLR_LIQ"),
        zero.alias("PERC_OFF"), zero.alias("VLR_OFF"), nz(c(i, "VLRIPI")).alias("VLR_IPI"),
        nz(c(i, "VLRICM")).alias("VLR_ICMS"), nz(c(i, "VLRICS")).alias("VLR_ST"),
        nz(c("PV", "VSTFCP")).alias("VLR_FUNDPOB"), c(i, "VLROUT").alias("VLR_OUT"),
        (c(i, "VLRLIQ") - (nz(c(i, "VLRIPI")) + nz(c(i, "VLRICS")) + nz(c("PV", "VSTFCP")) + nz(c(i, "VLROUT"))))
        .alias("VLR_SLI"),
        (c(i, "QTDFAT") * c(i, "PREUNI")).alias("VLRBRUTO_TOTAL"), (c(i, "QTDFAT") * 0).alias("VLRDESC_TOTAL"),
        F.lit("0").alias("MOTIVODEV"), c(i, "SEQISV").alias("SEQISV"))

    # -- returns -----------------------------------------------------------
    ipc_all = bronze("E440IPC")
    # fee share: COUNT(*) over ALL lines of the return note (5-column note key)
    note_keys = ["CODEMP", "CODFIL", "CODFOR", "CODSNF", "NUMNFC"]
    counts = B.line_counts(ipc_all, note_keys, "_N_LINES").alias("CNT")
    ipc = ipc_all.alias("I")
    nf = bronze("E140NFV").alias("NF")
    t = F.broadcast(codes.where(F.col("CPRTCF").isin(*RETURN_PURPOSES) & F.col("COMNAT").isin(*RETURN_NATURES_SALE, *RETURN_NATURES_CONSIGN))).alias("T")
    d = (ipc.join(t, (c("I", "CODEMP") == c("T", "CODEMP")) & (c("I", "TNSPRO") == c("T", "CODTNS")))
            .join(_return_notes(bronze, p).alias("N"), (c("I", "CODEMP") == c("N", "CODEMP")) & (c("I", "CODFIL") == c("N", "CODFIL"))
                  & (c("I", "SNFNFV") == c("N", "CODSNF")) & (c("I", "NUMNFC") == c("N", "NUMNFC"))
                  & (c("I", "CODFOR") == c("N", "CODFOR")))
            .join(nf, (c("I", "CODEMP") == c("NF", "CODEMP")) & (c("I", "CODFIL") == c("NF", "CODFIL"))
                  & (c("I", "SNFNFV") == c("NF", "CODSNF")) & (c("I", "NUMNFV") == c("NF", "NUMNFV")), "left")
            .join(counts, on("I", "CNT", *note_keys), "left"))
    nat = c("T", "COMNAT")
    entry = c("N", "TIPNFE")
    d = d.where((nat.isin(*RETURN_NATURES_SALE) & entry.isin(*RETURN_ENTRY_TYPES_SALE))
                | (nat.isin(*RETURN_NATURES_CONSIGN) & entry.isin(*RETURN_ENTRY_TYPES_CONSIGN)))
    i = "I"
    fee = F.when(F.coalesce(c(i, "ICMVFC"), F.lit(0)) == 0,
                 X.safe_div(c("N", "VSTFCP"), c("CNT", "_N_LINES"))).otherwise(c(i, "ICMVFC"))
    neg = lambda x: x * -1
    dev_blk = d.select(
        X.day(c("N", "DATENT")).alias("DATAREF"), F.lit("DEV").alias("TIPOREG"), zero.alias("VENDA"),
        c(i, "CODFIL").alias("CODFILIAL"),
        F.coalesce(c("NF", "USU_CLIBAS"), F.coalesce(c("N", "G_CLIBAS"), c("N", "C_CODCLI"))).alias("CODCLIBASE"),
        F.coalesce(c("NF", "CODCLI"), c("N", "F_CODCLI")).alias("CODCLI"),
        c(i, "NUMPED").alias("NUMPED"), c(i, "NUMNFV").alias("NUMNFV"), c(i, "NUMNFC").alias("NUMNFD"),
        F.when(c(i, "CODDER") == X.BLANK, X.oconcat(c(i, "CODPRO"), F.lit("-"), c(i, "CODFIL")))
        .otherwise(X.oconcat(c(i, "CODPRO"), F.lit("-"), c(i, "CODDER"), c(i, "CODFIL"))).alias("CHAVE_ITEM"),
        c(i, "CODDEP").alias("CODDEP"), c("N", "CODTRA").alias("CODTRANSP"), c("N", "CODCPG").alias("CODCPG"),
        c("N", "CODFPG").alias("CODFPG"),
        neg(c(i, "QTDREC")).alias("QTDITEM"), neg(c(i, "PREUNI")).alias("PRECOUNIT"),
        neg(c(i, "VLRLIQ")).alias("VLR_LIQ"), zero.alias("PERC_OFF"), zero.alias("VLR_OFF"),
        neg(c(i, "VECIPI")).alias("VLR_IPI"), neg(c(i, "VLRICM")).alias("VLR_ICMS"),
        neg(c(i, "VLRICS")).alias("VLR_ST"), neg(fee).alias("VLR_FUNDPOB"), neg(c(i, "VLROUT")).alias("VLR_OUT"),
        neg(c(i, "VLRLIQ") - (c(i, "VECIPI") + c(i, "VLRICS") + fee + c(i, "VLROUT"))).alias("VLR_SLI"),
        neg(c(i, "QTDREC") * c(i, "PREUNI")).alias("VLRBRUTO_TOTAL"), neg(c(i, "QTDREC") * 0).alias("VLRDESC_TOTAL"),
        c("N", "USU_MOTDEV").alias("MOTIVODEV"), c("N", "H_CODREP").alias("CODREP"),
        c("N", "R_USU_CODRVR").cast("string").alias("CODREGREP"),
        F.coalesce(c("NF", "USU_CODRVRCLI"), c("N", "C_USU_CODRVR").cast("string")).alias("CODREGCLI"),
        c(i, "SEQIPC").alias("SEQIPC"))
    return B.union_blocks([ped_blk, ven_blk, ser_blk, dev_blk], BILLING_COLUMNS)
