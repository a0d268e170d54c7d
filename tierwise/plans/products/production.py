"""Production products: DP-10 .. DP-16.

The performance fact (DP-16) is the heaviest query of the source system: four
blocks, each with correlated scalar sub-queries over the production log.  Here
every correlated sub-query becomes one grouped pre-aggregate joined on its
correlation keys, the validity-interval rate becomes a per-day rate table, and
the exact-day-else-latest look-up uses two pre-aggregates (blocks module).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ...functions import exprs as X
from ...operators import blocks as B
from ...operators.intervals import interval_rate
from ...operators.membership import keep_members
from ...operators import merge as M
from .common import Bronze, ProductParams, c, on

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
SERVICE_ORIGIN = "SER"
EXCLUDED_STAGES = ("99", "50")              # stages left out of performance
REWORK_STAGES = ("99", "50")                # stages whose balance is "in progress"
CONSUMPTION_TRANSACTIONS = ("90251", "90202")
ACTUAL_BUDGET_TYPE = "31"
RATE_MATRIX_TYPE = "28"
COST_CENTRE_LOW, COST_CENTRE_HIGH = "4000", "4300"
MATRIX_FLOOR = 1600
STOP_CLASSES = {1: "Operacional", 2: "Manutencao", 3: "Utilidades", 4: "TI", 5: "Externo"}
STOP_CLASS_EMPTY = "*** VAZIO ***"
DEC = "decimal(38,10)"
ORDER = ("CODEMP", "CODORI", "NUMORP")


def _date(v: str):
    return F.lit(v).cast("timestamp_ntz")


# ---------------------------------------------------------------------------
# DP-10 production products (variant tie-break against a legacy table)
# ---------------------------------------------------------------------------
def production_products(bronze: Bronze, p: ProductParams, legacy: DataFrame | None = None) -> DataFrame:
    """One row per (CODEMP, CODPRO).  ``legacy`` (CODEMP, CODPRO, CODDER) is the
    preferred variant list; ties resolve to the smallest CODDER."""
    spark = bronze("E075PRO").sparkSession
    legacy = legacy if legacy is not None else spark.createDataFrame([], "CODEMP long, CODPRO string, CODDER string")
    t0 = bronze("E075PRO").alias("T0")
    j = (t0.join(bronze("E075DER").alias("T1"), on("T1", "T0", "CODEMP", "CODPRO"), "left")
           .join(bronze("E013AGP").alias("T2"), (c("T2", "CODEMP") == c("T0", "CODEMP"))
                 & (c("T2", "CODAGP") == c("T1", "CODAGT")), "left")
           .join(bronze("E012FAM").alias("T3"), on("T3", "T0", "CODEMP", "CODFAM"), "left")
           .join(legacy.alias("LEG"), on("LEG", "T0", "CODEMP", "CODPRO"), "left")
           .where((c("T0", "CODEMP") == p.company) & ~c("T0", "CODORI").isin(SERVICE_ORIGIN)))
    flag = c("T0", "USU_INDFDL")
    rows = j.select(
        c("T0", "CODEMP").alias("CODEMP"), c("T0", "CODPRO").alias("CODPRO"), c("T0", "DESPRO").alias("DESPRO"),
        c("T1", "CODDER").alias("CODDER"), c("T0", "CODFAM").alias("CODFAM"), c("T3", "DESFAM").alias("DESFAM"),
        c("T0", "UNIMED").alias("UNIMED"), c("T0", "TIPPRO").alias("TIPPRO"), c("T0", "CODORI").alias("CODORI"),
        c("T0", "CODAGE").alias("CODAGE"), c("T1", "CODAGT").alias("CODAGT"), c("T2", "DESAGP").alias("DESAGP"),
        c("T0", "SITPRO").alias("SITPRO"), c("T1", "CURABC").alias("CURABC"), c("T0", "DEPPAD").alias("DEPPAD"),
        F.coalesce(X.space_default(flag, F.lit("N")), F.lit("N")).alias("USU_INDFDL"),
        F.when(X.blank_to_null(c("T1", "CODDER")) == X.blank_to_null(c("LEG", "CODDER")), 0).otherwise(1).alias("PRIORIDADE_LEGADO"))
    best = M.dedup_first(rows, ["CODEMP", "CODPRO"], order=["PRIORIDADE_LEGADO", "CODDER"])
    return best.drop("PRIORIDADE_LEGADO")          # helper column never reaches the table (PRJ-05)


# ---------------------------------------------------------------------------
# DP-11 cost centre x stage x resource x operation
# ---------------------------------------------------------------------------
def cost_centres(bronze: Bronze, p: ProductParams, listed_resources=()) -> DataFrame:
    """Operations linked to stages, plus the listed resource centres without a
    stage (``listed_resources`` is data supplied by the caller)."""
    opr = bronze("E720OPR").alias("OPR")
    a = (opr.join(bronze("E044CCU").alias("CCU"), on("CCU", "OPR", "CODEMP", "CODCCU"), "left")
            .join(bronze("E093ETG").alias("ETG"), on("ETG", "OPR", "CODEMP", "CODETG"), "left")
            .join(bronze("E725CRE").alias("CRE"), on("CRE", "OPR", "CODEMP", "CODCRE"), "left")
            .where(c("OPR", "CODEMP") == p.company)
            .select(c("OPR", "CODCCU").alias("CODCCU"), c("CCU", "DESCCU").alias("DESCCU"),
                    c("CCU", "ABRCCU").alias("ABRCCU"), c("CCU", "CCUPAI").alias("CCUPAI"),
                    c("OPR", "CODETG").alias("CODETG"), c("ETG", "DESETG").alias("DESETG"),
                    c("ETG", "ABRETG").alias("ABRETG"), c("OPR", "CODCRE").alias("CODCRE"),
                    c("CRE", "DESCRE").alias("DESCRE"), c("CRE", "ABRCRE").alias("ABRCRE"),
                    c("OPR", "CODOPR").alias("CODOPR"), c("OPR", "DESOPR").alias("DESOPR"),
                    c("OPR", "ABROPR").alias("ABROPR"), c("OPR", "UNICRE").alias("UNICRE"),
                    c("OPR", "MOVORP").alias("MOVORP")))
    cre = bronze("E725CRE").alias("CRE")
    b = (cre.join(bronze("E044CCU").alias("CCU"), on("CCU", "CRE", "CODEMP", "CODCCU"), "left")
            .join(bronze("E720OPR").alias("OPR"), on("CRE", "OPR", "CODEMP", "CODCRE"), "left")
            .where((c("CRE", "CODEMP") == p.company) & c("CRE", "CODCRE").isin(*[str(x) for x in listed_resources]))
            .select(c("CRE", "CODCCU").alias("CODCCU"), c("CCU", "DESCCU").alias("DESCCU"),
                    c("CCU", "ABRCCU").alias("ABRCCU"), c("CCU", "CCUPAI").alias("CCUPAI"),
                    F.lit("0").alias("CODETG"), F.lit(X.BLANK).alias("DESETG"), F.lit(X.BLANK).alias("ABRETG"),
                    c("CRE", "CODCRE").alias("CODCRE"), c("CRE", "DESCRE").alias("DESCRE"),
                    c("CRE", "ABRCRE").alias("ABRCRE"),
                    X.null_safe_key(c("OPR", "CODOPR")).alias("CODOPR"), c("OPR", "DESOPR").alias("DESOPR"),
                    c("OPR", "ABROPR").alias("ABROPR"), c("OPR", "UNICRE").alias("UNICRE"),
                    c("OPR", "MOVORP").alias("MOVORP")))
    # merge keys never hold NULL (a NULL key would be re-inserted on every run)
    return M.fill_null_keys(a.unionByName(b), ["CODCCU", "CODETG", "CODCRE", "CODOPR"])


# ---------------------------------------------------------------------------
# DP-12 standard cost (sheet)
# ---------------------------------------------------------------------------
def standard_cost(sheet: DataFrame) -> DataFrame:
    """Sheet ``CP`` read as text: decimal comma, tolerant company code, required
    fields.  Bad cost text becomes NULL and the row is dropped (the source
    raised); :func:`standard_cost_rejects` counts those rows."""
    df = sheet.toDF(*[h.strip().upper() for h in sheet.columns])
    df = df.withColumn("CUSTO_PADRAO", X.locale_decimal("CUSTO_PADRAO")) \
           .withColumn("CODEMPRESA", F.col("CODEMPRESA").cast("string").try_cast("long"))
    df = df.dropna(subset=["PRODUTO", "CUSTO_PADRAO"])
    return df.where(F.trim("PRODUTO") != "")


def standard_cost_rejects(sheet: DataFrame) -> DataFrame:
    df = sheet.toDF(*[h.strip().upper() for h in sheet.columns])
    bad = F.col("CUSTO_PADRAO").isNotNull() & X.locale_decimal("CUSTO_PADRAO").isNull()
    return df.where(bad)


# ---------------------------------------------------------------------------
# DP-13 stoppages
# ---------------------------------------------------------------------------
def stoppages(bronze: Bronze, p: ProductParams) -> DataFrame:
    t0 = bronze("E930MPR").alias("T0")
    j = (t0.join(bronze("E018MTV").alias("T1"), on("T1", "T0", "CODEMP", "CODMTV"), "left")
           .join(bronze("E093ETG").alias("T2"), on("T2", "T0", "CODEMP", "CODETG"), "left")
           .join(bronze("E044CCU").alias("T3"), (c("T3", "CODEMP") == c("T0", "CODEMP"))
                 & (c("T3", "CODCCU") == c("T2", "CODCCU")), "left")
           .where(c("T0", "DATMPR") > _date(p.production_cutoff)))          # strict (FIL-04)
    cla = c("T1", "USU_CLAMTV")
    decode = F.when(F.lit(False), None)
    for k, v in STOP_CLASSES.items():
        decode = decode.when(cla == k, v)
    hours = lambda col: F.round(col.cast("decimal(18,0)") / 60, 2)  # noqa: E731  exact, half-up
    return j.select(
        c("T0", "CODETG").alias("CODETG"), c("T0", "CODCRE").alias("CODCRE"), c("T2", "CODCCU").alias("CODCCU"),
        c("T3", "DESCCU").alias("DESCCU"), c("T0", "IDEBEM").alias("IDEBEM"), c("T0", "DATMPR").alias("DATMPR"),
        c("T0", "CODMTV").alias("CODMTV"), c("T1", "DESMTV").alias("DESMTV"), c("T1", "ABRMTV").alias("ABRMTV"),
        c("T1", "USU_TIPMTV").alias("TIPMTV"),
        F.when(c("T1", "USU_TIPMTV") == 1, "Programado").otherwise("Nao Programado").alias("DESTIP"),
        cla.alias("CLAMTV"), decode.otherwise(STOP_CLASS_EMPTY).alias("DESCLA"),
        c("T0", "SEQMPR").alias("SEQMPR"), c("T0", "HORINI").alias("HORCHA"),
        hours(c("T0", "HORINI")).alias("HORINI"), hours(c("T0", "HORFIM")).alias("HORFIM"))


# ---------------------------------------------------------------------------
# DP-14 cost-centre budget entries
# ---------------------------------------------------------------------------
def budget_entries(bronze: Bronze, p: ProductParams) -> DataFrame:
    t0 = bronze("E626ORC").alias("T0")
    j = (t0.join(bronze("E047NTG").alias("T1"), on("T0", "T1", "CODEMP", "CODNTG"))
           .join(bronze("E621MTC").alias("T2"), on("T0", "T2", "CODEMP", "NUMMTC"))
           .where((c("T0", "CODCCU") > COST_CENTRE_LOW) & (c("T0", "CODCCU") < COST_CENTRE_HIGH)  # text range
                  & (c("T0", "NUMMTC") > MATRIX_FLOOR)                                          # number (T7)
                  & (c("T2", "DATINI") >= _date(p.production_cutoff))))
    return j.select(
        c("T0", "CODEMP").alias("CODEMP"), c("T0", "NUMMTC").alias("NUMMTC"), c("T2", "TIPMTC").alias("TIPMTC"),
        F.when(c("T2", "TIPMTC") == ACTUAL_BUDGET_TYPE, "REALIZADO").otherwise("ORCADO").alias("TIPORC"),
        c("T2", "CODMTC").alias("CODMTC"), c("T2", "DESMTC").alias("DESMTC"), c("T0", "CODCCU").alias("CODCCU"),
        c("T0", "CODNTG").alias("CODNTG"), c("T1", "DESNTG").alias("DESNTG"),
        c("T2", "DATINI").alias("DATINI"), c("T2", "DATFIM").alias("DATFIM"))


# ---------------------------------------------------------------------------
# DP-15 utilisation target (sheet)
# ---------------------------------------------------------------------------
def utilisation_target(sheet: DataFrame, p: ProductParams) -> DataFrame:
    df = sheet.toDF(*[h.strip().upper() for h in sheet.columns])
    df = df.dropna(subset=["DATA", "CD_CENTROCUSTO"])
    num = lambda col: F.coalesce(F.col(col).cast("string").try_cast("double"), F.lit(0.0))
    df = df.select(
        F.col("DATA").cast("string").try_cast("timestamp_ntz").alias("DATA"),
        F.trim(F.col("CD_CENTROCUSTO").cast("string")).alias("CD_CENTROCUSTO"),
        num("MIN_DIA").alias("MIN_DIA"), num("DIAS_UTEIS").alias("DIAS_UTEIS"),
        num("LIMITE_SUPERIOR").alias("LIMITE_SUPERIOR"),
        *[F.col(x) for x in df.columns if x not in ("DATA", "CD_CENTROCUSTO", "MIN_DIA", "DIAS_UTEIS",
                                                     "LIMITE_SUPERIOR")])
    return df.where(F.col("DATA") >= _date(p.production_cutoff))


# ---------------------------------------------------------------------------
# DP-16 production performance (four blocks)
# ---------------------------------------------------------------------------
PERFORMANCE_COLUMNS = [
    ("TIPTAB", "int"), ("DESTAB", "string"), ("CODEMP", "bigint"), ("DATMOV", "timestamp_ntz"),
    ("DATREA", "timestamp_ntz"), ("NUMORP", "bigint"), ("CC_EXE", "string"), ("CODOPR", "string"),
    ("CODETG", "string"), ("CODCRE", "string"), ("CODORI", "string"), ("CODPRO", "string"),
    ("PROCON", "string"), ("TIPCON", "string"), ("NUMMTC", "bigint"), ("CODNTG", "string"),
    ("QTDPRV", DEC), ("QTDREA", DEC), ("QTDTOP", DEC), ("QTDCOR", DEC), ("QTDAND", DEC), ("QTDRFG", DEC),
    ("TMPPRP", DEC), ("TMPPRV", DEC), ("TMPBRU", DEC), ("TMPLIQ", DEC), ("TAXREA", DEC), ("CUSMOV", DEC),
    ("QTDHOR", DEC), ("HORINI", "bigint"), ("VALVIS", DEC), ("TIPCUS", "string"), ("SITORP", "string"),
    ("DTRINI", "timestamp_ntz"), ("DTRFIM", "timestamp_ntz"), ("CODFAM", "string"),
    ("CD_TIPO_MP_PERSONALIZADO", "string"),
]


def _cc_exe(resource_cc, stage_cc):
    """Resource's cost centre unless it is blank; a missing resource gives NULL."""
    return F.when(resource_cc == X.BLANK, stage_cc).otherwise(resource_cc)


def _scaled(sum_col, unit):
    return (F.when(unit == "M", sum_col).when(unit == "D", sum_col * 1440).when(unit == "H", sum_col * 60)
            .when(unit == "S", sum_col / 60).otherwise(sum_col))


def performance(bronze: Bronze, p: ProductParams) -> DataFrame:
    """Entries, operations and quantities of orders that block 1 leaves out, and entries that
    no consumption of block 2 asks for, are left out before they move; what is joined
    comes narrow before wide."""
    cut = _date(p.production_cutoff)
    eoq = bronze("E900EOQ")
    cop = bronze("E900COP").where(F.col("DTRINI") >= cut)
    n = cop.count()

    def asked(df):
        return keep_members(df, ORDER, cop, expected=n)

    # ---- block 1: performance ------------------------------------------
    floor = (F.col("DATREA") > F.lit(p.performance_floor).cast("timestamp_ntz")) & ~F.col("CODETG").isin(*EXCLUDED_STAGES)
    z1 = asked(eoq.where(floor))
    entries = _entry_totals(z1)
    spe = (asked(bronze("E630SPE")).where(F.col("CODETG").isin(*REWORK_STAGES))
           .groupBy("CODEMP", "CODORI", "NUMORP", "CODPRO").agg(F.sum("SDOATU").alias("_SDO")))
    mtc = bronze("E621MTC").where(F.col("TIPMTC") == RATE_MATRIX_TYPE).alias("Y0")
    tax = bronze("E626TAX").alias("Y1")
    rates = mtc.join(tax, on("Y0", "Y1", "CODEMP", "NUMMTC")).select(
        c("Y0", "CODEMP").alias("CODEMP"), c("Y1", "CODCCU").alias("CODCCU"),
        c("Y0", "DATINI").alias("DATINI"), c("Y0", "DATFIM").alias("DATFIM"), c("Y1", "TAXCUS").alias("TAXCUS"))

    # the balance in progress hangs on the order: it is joined to the orders, not to the entries
    t0 = cop.join(spe, [*ORDER, "CODPRO"], "left").alias("T0")
    cc = _cc_exe(c("X2", "CODCCU"), c("X1", "CODCCU"))

    def centred(df, *columns):
        return (df.alias("Z1").join(bronze("E093ETG").alias("X1"), on("X1", "Z1", "CODEMP", "CODETG"), "left")
                  .join(bronze("E725CRE").alias("X2"), on("X2", "Z1", "CODEMP", "CODCRE"), "left")
                  .select(*[c("Z1", x).alias(x) for x in columns], cc.alias("CC_EXE")))
    # the moments whose rate is asked for, without what the entries are joined with
    moments = centred(z1.select("CODEMP", "CODETG", "CODCRE", "DATREA").distinct(), "CODEMP", "DATREA").withColumnRenamed("DATREA", "_ts")
    j1 = centred(z1, *ORDER, "DATREA", "CODETG", "CODCRE", "CODPRO", "CODDER", "SEQROT", "CODOPR").withColumnRenamed("CODOPR", "_Z1OPR")
    j1 = _block1_joins(j1, entries, rates, moments)
    j1 = (j1.alias("J").join(t0, on("T0", "J", *ORDER))
            .select("J.*", c("T0", "SITORP").alias("_SITORP"), c("T0", "DTRINI").alias("_DTRINI"), c("T0", "DTRFIM").alias("_DTRFIM"), c("T0", "_SDO").alias("_SDO")))
    j1 = (j1.alias("J").join(asked(bronze("E900QDO")).alias("T3"), on("T3", "J", *ORDER, "CODPRO", "CODDER"), "left")
            .select("J.*", c("T3", "QTDPRV").alias("_QTDPRV"), c("T3", "QTDRFG").alias("_QTDRFG")))
    t2 = asked(bronze("E900OOP")).where((F.col("SFXETR") == "1") & (F.col("SFXSEQ") == "1"))
    j1 = (j1.alias("J").join(t2.alias("T2"), on("T2", "J", *ORDER, "CODETG", "SEQROT"), "left")
            .select("J.*", c("T2", "CODOPR").alias("CODOPR"), c("T2", "UNICRE").alias("UNICRE"), c("T2", "CODEMP").alias("_T2EMP"), c("T2", "TMPPRP").alias("_TMPPRP")))
    rate = F.when(F.col("_T2EMP").isNotNull(), F.col("_RATE"))      # an entry without an operation has none
    and_ = F.when(X.same_month(F.col("_DTRFIM"), F.col("DATREA")), F.lit(0)).otherwise(F.col("_SDO"))
    g1 = j1.groupBy("CODEMP", "DATREA", "NUMORP", "CODETG", "CODCRE", "CC_EXE", "CODOPR", "CODORI", "CODPRO",
                    "UNICRE").agg(
        F.sum("_QTDPRV").alias("QTDPRV"), F.avg("_QTDREA").alias("QTDREA"), F.avg(and_).alias("QTDAND"),
        F.sum("_QTDRFG").alias("QTDRFG"), F.sum("_TMPPRP").alias("_STMP"), F.avg("_TMPBRU").alias("TMPBRU"),
        F.avg(F.coalesce(rate, F.lit(0))).alias("TAXREA"), F.max("_SITORP").alias("SITORP"),
        F.max("_DTRINI").alias("DTRINI"), F.max("_DTRFIM").alias("DTRFIM"))
    blk1 = g1.select(
        F.lit(1).alias("TIPTAB"), F.lit("DESEMPENHO").alias("DESTAB"), "CODEMP", "DATREA", "NUMORP", "CC_EXE",
        "CODOPR", "CODETG", "CODCRE", "CODORI", "CODPRO", "QTDPRV", "QTDREA", "QTDAND", "QTDRFG",
        _scaled(F.col("_STMP"), F.col("UNICRE")).alias("TMPPRP"),
        (_scaled(F.col("_STMP"), F.col("UNICRE")) * F.col("QTDPRV")).alias("TMPPRV"),
        "TMPBRU", "TAXREA", F.lit("Processo").alias("TIPCUS"), "SITORP", "DTRINI", "DTRFIM")

    # ---- block 2: raw-material consumption ------------------------------
    valid = (F.col("HORREA") > 0) & ~F.col("CODETG").isin(*EXCLUDED_STAGES)
    t0 = bronze("E210MVP").where((F.col("DATMOV") >= cut) & F.col("CODTNS").isin(*CONSUMPTION_TRANSACTIONS) & ~F.col("CODETG").isin(*EXCLUDED_STAGES))
    n_moved = t0.count()

    def consumed(df):
        return keep_members(df, ORDER, t0, ("CODEMP", "ORIORP", "NUMDOC"), expected=n_moved)
    # consumption from the cutoff on asks for whole months of production
    t3 = consumed(eoq.where(valid & (F.col("DATREA") >= F.date_trunc("month", cut).cast("timestamp_ntz")))).repartition("NUMORP", "CODETG", "SEQROT")
    t3 = _with_month_total(t3.groupBy(*ORDER, "CODETG", "DATREA", "CODCRE", "SEQROT").agg(F.sum("QTDRE1").alias("QTDRE1")))
    reach = consumed(eoq.where(valid & (F.col("DATREA") >= F.lit(p.consumption_reach).cast("timestamp_ntz"))))
    j2 = (t0.alias("T0").join(bronze("E075PRO").alias("T1"), on("T1", "T0", "CODEMP", "CODPRO"), "left")
            .join(t3.alias("T3"), (c("T3", "CODEMP") == c("T0", "CODEMP")) & (c("T3", "CODORI") == c("T0", "ORIORP"))
                  & (c("T3", "NUMORP") == c("T0", "NUMDOC")) & (c("T3", "CODETG") == c("T0", "CODETG"))
                  & (c("T3", "DATREA") == c("T0", "DATMOV")), "left")
            .join(bronze("E093ETG").alias("X1"), on("X1", "T0", "CODEMP", "CODETG"), "left")
            .join(bronze("E725CRE").alias("X2"), (c("X2", "CODEMP") == c("T0", "CODEMP"))
                  & (c("X2", "CODCRE") == c("T3", "CODCRE")), "left"))
    j2 = j2.select(
        c("T0", "CODEMP").alias("CODEMP"), c("T0", "NUMDOC").alias("NUMORP"), c("T0", "DATMOV").alias("DATMOV"),
        _cc_exe(c("X2", "CODCCU"), c("X1", "CODCCU")).alias("CC_EXE"), c("T0", "CODETG").alias("CODETG"),
        c("T3", "CODCRE").alias("CODCRE"), c("T0", "ORIORP").alias("CODORI"),
        c("T0", "CODPRO").alias("PROCON"), c("T1", "TIPPRO").alias("TIPCON"), c("T1", "CODFAM").alias("CODFAM"),
        c("T3", "_QTDTOP").alias("_QTDTOP"), c("T0", "QTDMOV").alias("_QTDMOV"),
        X.signed(c("T0", "VLRMOV"), c("T0", "ESTEOS"), "S").alias("_CUS"))
    # the order's product and its latest day move the rows together
    j2 = (j2.alias("J").join(bronze("E900COP").alias("T2"), on("T2", "J", *ORDER), "left").select("J.*", c("T2", "CODPRO").alias("CODPRO")))
    # DATREA: exact day in the look-up reach, else the latest (FIL-06, JON-13)
    j2 = B.lookup_exact_or_latest(j2, reach.select(*ORDER, "DATREA"), ORDER, F.col("DATMOV"), F.col("DATREA"), F.col("DATREA"), "_DATREA")
    g2 = j2.groupBy("CODEMP", "NUMORP", "DATMOV", "CC_EXE", "CODETG", "CODCRE", "CODORI", "CODPRO", "PROCON",
                    "TIPCON", "CODFAM").agg(
        F.max("_DATREA").alias("DATREA"), F.avg("_QTDTOP").alias("QTDTOP"), F.sum("_QTDMOV").alias("QTDCOR"),
        F.sum("_CUS").alias("CUSMOV"))
    blk2 = g2.select(
        F.lit(2).alias("TIPTAB"), F.lit("CONSUMO").alias("DESTAB"), "CODEMP", "DATMOV", "DATREA", "NUMORP",
        "CC_EXE", F.lit(X.BLANK).alias("CODOPR"), "CODETG", "CODCRE", "CODORI", "CODPRO", "PROCON", "TIPCON",
        "QTDTOP", "QTDCOR", "CUSMOV", F.lit("Consumo").alias("TIPCUS"), "CODFAM",
        F.when(F.col("TIPCON") == "P", "CO").otherwise("MP").alias("CD_TIPO_MP_PERSONALIZADO"))

    # ---- block 3: stoppages ---------------------------------------------
    s0 = bronze("E930MPR").alias("T0")
    j3 = (s0.join(bronze("E018MTV").alias("T1"), on("T1", "T0", "CODEMP", "CODMTV"), "left")
            .join(bronze("E093ETG").alias("T2"), on("T2", "T0", "CODEMP", "CODETG"), "left")
            .join(bronze("E044CCU").alias("T3"), (c("T3", "CODEMP") == c("T0", "CODEMP"))
                  & (c("T3", "CODCCU") == c("T2", "CODCCU")), "left")
            .where(c("T0", "DATMPR") > cut))
    blk3 = j3.select(
        F.lit(3).alias("TIPTAB"), F.lit("PARADAS").alias("DESTAB"), c("T0", "CODEMP").alias("CODEMP"),
        c("T0", "DATMPR").alias("DATREA"), c("T2", "CODCCU").alias("CC_EXE"), F.lit(X.BLANK).alias("CODOPR"),
        c("T0", "CODETG").alias("CODETG"), c("T0", "CODCRE").alias("CODCRE"), F.lit(X.BLANK).alias("CODORI"),
        F.lit(X.BLANK).alias("CODPRO"), c("T0", "QTDHOR").alias("QTDHOR"), c("T0", "HORINI").alias("HORINI"))

    # ---- block 4: cost-centre budget ------------------------------------
    o0 = bronze("E626ORC").alias("T0")
    j4 = (o0.join(bronze("E047NTG").alias("T1"), on("T1", "T0", "CODEMP", "CODNTG"), "left")
            .join(bronze("E621MTC").alias("T2"), on("T2", "T0", "CODEMP", "NUMMTC"), "left")
            .where((c("T0", "CODCCU") > COST_CENTRE_LOW) & (c("T0", "CODCCU") < COST_CENTRE_HIGH)
                   & (c("T0", "NUMMTC") > MATRIX_FLOOR) & (c("T2", "DATINI") >= cut)))
    blk4 = j4.select(
        F.lit(4).alias("TIPTAB"), F.lit("CUSTO_CC").alias("DESTAB"), c("T0", "CODEMP").alias("CODEMP"),
        c("T2", "DATINI").alias("DATREA"), c("T0", "CODCCU").alias("CC_EXE"), F.lit(X.BLANK).alias("CODOPR"),
        F.lit(X.BLANK).alias("CODCRE"), F.lit(X.BLANK).alias("CODORI"), F.lit(X.BLANK).alias("CODPRO"),
        c("T0", "NUMMTC").alias("NUMMTC"), c("T0", "CODNTG").alias("CODNTG"), c("T0", "VALVIS").alias("VALVIS"))
    return B.union_blocks([blk1, blk2, blk3, blk4], PERFORMANCE_COLUMNS)


def _entry_totals(entries):
    """``_TMPBRU`` of each (entry, operation) and ``_QTDREA`` of its entry over all
    operations: one aggregate, and a sum over its rows, in one movement.  The operation may be missing."""
    entry = [*ORDER, "CODETG", "SEQROT", "DATREA"]
    g = entries.repartition("NUMORP", "CODETG", "SEQROT", "DATREA").groupBy(*entry, F.col("CODOPR").alias("_OPR")).agg(F.sum("TMPBRU").alias("_TMPBRU"), F.sum("QTDRE1").alias("_Q"))
    total = F.sum("_Q").over(Window.partitionBy(*entry)).cast(g.schema["_Q"].dataType)
    return g.select(*entry, "_OPR", F.when(F.col("_OPR").isNotNull(), F.col("_TMPBRU")).alias("_TMPBRU"), total.alias("_QTDREA"))


def _block1_joins(j1, entries, rates, moments):
    """Correlated scalars of block 1 as pre-aggregates joined on their keys."""
    entry = [*ORDER, "CODETG", "SEQROT", "DATREA"]
    r = rates.withColumnRenamed("CODCCU", "CC_EXE")
    j1 = interval_rate(j1, r, ["CODEMP", "CC_EXE"], F.col("DATREA"), "DATINI", "DATFIM", "TAXCUS", name="_RATE", moments=moments)
    return (j1.alias("J").join(entries.alias("E"), on("J", "E", *entry) & c("J", "_Z1OPR").eqNullSafe(c("E", "_OPR")), "left")
              .select("J.*", "E._TMPBRU", "E._QTDREA"))


def _with_month_total(t3):
    """Month-wide produced quantity of the routing step (same month and year): a sum over
    the day totals; none for a missing step."""
    month = Window.partitionBy(*ORDER, "CODETG", "SEQROT", X.month_start("DATREA"))
    total = F.sum("QTDRE1").over(month).cast(t3.schema["QTDRE1"].dataType)
    return t3.withColumn("_QTDTOP", F.when(F.col("SEQROT").isNotNull(), total))
