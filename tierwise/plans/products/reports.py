"""RMA report products: DP-17 .. DP-21."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ...functions import exprs as X
from ...operators import blocks as B
from ...operators.heavy_keys import heavy_left_join
from ...operators.membership import keep_members
from ...sources import sheets
from .common import Bronze, ProductParams, c, on
from .commercial import AUTHORISED_DOC, BILLED, ISSUED_NOTE, SALE_NOTE_TYPES

# Fixed values
FINISHED_SITUATIONS = ("3", "4", "5", "6", "8")
FINISHED_AGGREGATE_TYPE = "T"
PRODUCT_HEADER_MAP = {
    "CÓD. PRODUTO": "CD_PRODUTO",
    "NOVO CÓDIGO": "CD_PRODUTO_NOVO",
    "CÓD. CLASSIFICAÇÃO": "CD_CLASSIF_PROD",
    "CLASSIFICAÇÃO": "DS_CLASSIF_PROD",
    "CÓD. SITUAÇÃO": "CD_SIT_INDICADOR",
    "SITUAÇÃO": "DS_SIT_INDICADOR",
    "CÓD. SITUAÇÃO 2": "CD_SIT_INDICADOR_2",
    "SITUAÇÃO 2": "DS_SIT_INDICADOR_2",
}


def _clean_text_sheet(sheet: DataFrame) -> DataFrame:
    df = sheet.toDF(*[h.strip().upper() for h in sheet.columns])
    return df.select(*[F.trim(F.col(f"`{h}`").cast("string")).alias(h) for h in df.columns])


# ---------------------------------------------------------------------------
# DP-17 index hierarchy
# ---------------------------------------------------------------------------
def rma_index(sheet: DataFrame) -> DataFrame:
    df = sheet.toDF(*[h.strip().upper() for h in sheet.columns])
    return df.dropna(subset=["ID"])


# ---------------------------------------------------------------------------
# DP-18 defect reclassification
# ---------------------------------------------------------------------------
def defect_reclassification(sheet: DataFrame) -> DataFrame:
    df = sheets.required(_clean_text_sheet(sheet), ["PRODUTO", "CÓDIGO"])
    df = df.withColumn("PROD_COD_DEF", F.concat_ws("|", F.col("PRODUTO"), F.col("`CÓDIGO`")))
    return df.where(~sheets.separator_only("PROD_COD_DEF"))


# ---------------------------------------------------------------------------
# DP-19 product reclassification
# ---------------------------------------------------------------------------
def product_reclassification(sheet: DataFrame) -> DataFrame:
    df = sheets.required(_clean_text_sheet(sheet), ["CÓD. PRODUTO"])
    return sheets.rename_present(df, PRODUCT_HEADER_MAP)


# ---------------------------------------------------------------------------
# DP-20 monthly sales and trailing 6 months per product
# ---------------------------------------------------------------------------
def rma_sales(bronze: Bronze, p: ProductParams) -> DataFrame:
    # notes older than 6 months before the cutoff never reach a kept month
    notes = bronze("E140NFV")
    t0 = notes.where(F.col("DATEMI") >= B.window_floor(p.reports_cutoff, 6).cast("timestamp_ntz")).alias("T0")
    j = (t0.join(bronze("E140IPV").alias("T1"), on("T0", "T1", "CODEMP", "CODFIL", "CODSNF", "NUMNFV"), "left")
           .join(bronze("E140IDE").alias("T2"), on("T0", "T2", "CODEMP", "CODFIL", "CODSNF", "NUMNFV"), "left")
           .join(bronze("E001TNS").alias("T3"), (c("T1", "CODEMP") == c("T3", "CODEMP"))
                 & (c("T1", "TNSPRO") == c("T3", "CODTNS")), "left")
           .where((c("T0", "CODEMP") == p.company) & (c("T0", "SITNFV") == ISSUED_NOTE)
                  & c("T0", "TIPNFS").isin(*SALE_NOTE_TYPES) & (c("T2", "SITDOE") == AUTHORISED_DOC)
                  & (c("T3", "VENFAT") == BILLED)))
    monthly = (j.select(X.month_start(c("T0", "DATEMI")).alias("MES"), c("T1", "CODPRO").alias("CODPRO"),
                        c("T1", "QTDFAT").alias("QTDFAT"))
                .groupBy("MES", "CODPRO").agg(F.sum("QTDFAT").alias("QTD_MES")))
    # QTDMED is named an average by the source but is a SUM; kept as a sum.
    r = B.trailing_months(monthly, "CODPRO", "MES", "QTD_MES", back=6, skip=1, out="QTDMED",
                          cutoff=p.reports_cutoff)
    datref = F.last_day("MES")
    return r.select(
        F.lit(1).alias("TIPREG"), datref.alias("DATREF"), F.last_day(F.add_months("MES", -1)).alias("DATFIM"),
        F.add_months("MES", -6).alias("DATINI"), F.lit(p.company).cast("bigint").alias("CODEMP"), "CODPRO",
        "QTDMED", X.pipe_key(F.month(datref), F.year(datref), F.col("CODPRO")).alias("VENDA_MES_ANO_PRODUTO"))


# ---------------------------------------------------------------------------
# DP-21 report items
# ---------------------------------------------------------------------------
def repeat_entries(bronze: Bronze, p: ProductParams, items: DataFrame | None = None) -> DataFrame:
    """(DATENT, USU_SERMAC, DATREI): previous entry of the same serial.

    LAG over DISTINCT (entry, serial) pairs; blank and NULL serials are left
    out before the window (they are the natural hot key).  ``items`` may leave out
    items that have no entry note from the cutoff on."""
    t2 = (bronze("USU_TLAUITE") if items is None else items).alias("T2")
    t1 = bronze("E440NFC").alias("T1")
    pairs = (t2.join(t1, (c("T2", "USU_CODEMP") == c("T1", "CODEMP")) & (c("T2", "USU_CODFIL") == c("T1", "CODFIL"))
                     & (c("T2", "USU_CODFOR") == c("T1", "CODFOR")) & (c("T2", "USU_NUMNFC") == c("T1", "NUMNFC")),
                     "left")
               .where((c("T1", "DATENT") > F.lit(p.reports_cutoff).cast("timestamp_ntz"))      # strict (FIL-04)
                      & c("T2", "USU_SERMAC").isNotNull() & (c("T2", "USU_SERMAC") != X.BLANK))
               .select(c("T1", "DATENT").alias("DATENT"), c("T2", "USU_SERMAC").alias("USU_SERMAC"))
               .distinct())
    w = Window.partitionBy("USU_SERMAC").orderBy(F.col("DATENT").asc())
    return pairs.withColumn("DATREI", F.lag("DATENT").over(w))


TRACKED = ("NUMOCP", "DATEMIOCP", "CODFOR", "NOMFOR", "USU_NUMINV", "USU_DATEMB", "NUMNFC", "DATEMINFC")
NOTE = ("USU_CODEMP", "USU_CODFIL", "USU_CODFOR", "USU_NUMNFC")
FEW_TECHNICIANS = 1 << 19     # some 50 MB as a broadcast
ITEM = (*NOTE, "USU_SEQIPC", "USU_SEQUNI", "USU_CODLAU", "USU_SERMAC", "USU_CODPRO", "USU_CODDER", "USU_CODDEF", "USU_PECFAL", "USU_PECTRO",
        "USU_CODCOR", "USU_USUTEC", "USU_TMPUTI", "USU_OBSCLI", "USU_CODPRB")
ENTERED = ("CODEMP", "CODFIL", "CODFOR", "NUMNFC")
ENTRY = ("DATENT", "USU_DATCON")
SUPPLIER = ("NOMFOR", "SIGUFS", "CIDFOR", "CODCLI", "TIPFOR", "FONFOR", "FONFO2", "FONFO3", "INTNET")
HEAD = ("USU_TIPLAU", "USU_CODSIT", "USU_NUMNFV", "USU_USUFIN", "USU_DATALT", "USU_DATSEP")
OUTGOING = ("DATEMI", "USU_CODRAS", "USU_ENTCOR", "CODTRA")
HEAD_KEY = ("USU_CODLAU", "USU_CODEMP", "USU_CODFIL")
HEAD_TEXTS = ("USU_DESTIP", "USU_DESSIT", *OUTGOING, "APETRA")
PRODUCT = ("USU_CODEMP", "USU_CODPRO", "USU_CODDER", "USU_CODDEF")
PRODUCT_TEXTS = ("USU_DESDEF", "CODAGT", "DESAGP", "CODORI", "ORIMER")


def _entry_notes(notes: DataFrame, bronze: Bronze) -> DataFrame:
    """Entry notes, each with its supplier."""
    t6, t7 = notes.alias("T6"), bronze("E095FOR").alias("T7")
    return (t6.join(t7, c("T6", "CODFOR") == c("T7", "CODFOR"), "left")
              .select(*[c("T6", x).alias(y) for x, y in zip(ENTERED, NOTE)],
                      *[c("T6", x).alias(f"T6_{x}") for x in ENTRY], *[c("T7", x).alias(f"T7_{x}") for x in SUPPLIER]))


def _report_heads(bronze: Bronze, items: DataFrame, n: int) -> DataFrame:
    """Heads of the ``n`` items with their type, situation, outgoing note and carrier."""
    heads = keep_members(bronze("USU_TLAUGER"), HEAD_KEY, items, expected=n)
    outgoing = keep_members(bronze("E140NFV"), ("CODEMP", "CODFIL", "NUMNFV"), heads, ("USU_CODEMP", "USU_CODFIL", "USU_NUMNFV"), expected=n)
    t1 = heads.alias("T1")
    return (t1.join(bronze("USU_TLAUTIP").alias("T2"), c("T1", "USU_TIPLAU") == c("T2", "USU_CODTIP"), "left")
              .join(bronze("USU_TLAUSIT").alias("T4"), c("T1", "USU_CODSIT") == c("T4", "USU_CODSIT"), "left")
              .join(outgoing.alias("T12"), (c("T12", "CODEMP") == c("T1", "USU_CODEMP"))
                    & (c("T12", "CODFIL") == c("T1", "USU_CODFIL")) & (c("T12", "NUMNFV") == c("T1", "USU_NUMNFV")), "left")
              .join(bronze("E073TRA").alias("T13"), c("T13", "CODTRA") == c("T12", "CODTRA"), "left")
              .select(*[c("T1", x).alias(x) for x in (*HEAD_KEY, *HEAD)],
                      c("T2", "USU_DESTIP").alias("USU_DESTIP"), c("T4", "USU_DESSIT").alias("USU_DESSIT"),
                      *[c("T12", x).alias(x) for x in OUTGOING], c("T13", "APETRA").alias("APETRA")))


def _item_products(bronze: Bronze, items: DataFrame) -> DataFrame:
    """The product, variant and defect texts of each (company, product, variant, defect)
    that items have, a missing one included: the look-ups move these keys, not the items."""
    k = items.select(*PRODUCT).distinct().alias("K")
    t9 = (bronze("E075DER").alias("T9")
          .join(bronze("E013AGP").alias("T10"), (c("T9", "CODEMP") == c("T10", "CODEMP"))
                & (c("T9", "CODAGT") == c("T10", "CODAGP")) & (c("T10", "TIPAGP") == FINISHED_AGGREGATE_TYPE), "left")
          .select(*[c("T9", x).alias(x) for x in ("CODEMP", "CODPRO", "CODDER", "CODAGT")], c("T10", "DESAGP").alias("DESAGP"))).alias("T9")
    return (k.join(bronze("USU_TLAUDEF").alias("T3"), on("K", "T3", *PRODUCT), "left")
             .join(t9, (c("T9", "CODEMP") == c("K", "USU_CODEMP")) & (c("T9", "CODPRO") == c("K", "USU_CODPRO"))
                   & (c("T9", "CODDER") == c("K", "USU_CODDER")), "left")
             .join(bronze("E075PRO").alias("T8"), (c("K", "USU_CODEMP") == c("T8", "CODEMP"))
                   & (c("K", "USU_CODPRO") == c("T8", "CODPRO")), "left")
             .select(*[c("K", x).alias(x) for x in PRODUCT], c("T3", "USU_DESDEF").alias("USU_DESDEF"),
                     c("T9", "CODAGT").alias("CODAGT"), c("T9", "DESAGP").alias("DESAGP"),
                     c("T8", "CODORI").alias("CODORI"), c("T8", "ORIMER").alias("ORIMER")))


def _technicians(bronze: Bronze, items: DataFrame, n: int) -> DataFrame:
    """Users that the ``n`` items name as technicians; broadcast where they are few."""
    users = keep_members(bronze("R910USU"), ["CODENT"], items, ["USU_USUTEC"], n).select("CODENT", "NOMCOM")
    return F.broadcast(users) if users.count() <= FEW_TECHNICIANS else users


def report_items(bronze: Bronze, p: ProductParams) -> DataFrame:
    """Items of entry notes from the cutoff on, which are joined first; other items, and the
    heads, outgoing notes and tracking rows that only they ask for, are left out before they
    move.  Look-ups that hang on a look-up (supplier on note, carrier on head, aggregate on
    variant) are joined to it beforehand, so items are shuffled once for each key of their
    own; the wider a look-up, the later it comes."""
    notes = bronze("E440NFC").where(F.col("DATENT") >= F.lit(p.reports_cutoff).cast("timestamp_ntz"))
    items = keep_members(bronze("USU_TLAUITE").select(*ITEM), NOTE, notes, ENTERED)
    n = items.count()
    t0 = items.join(_entry_notes(notes, bronze), list(NOTE)).select(*ITEM, *[f"T6_{x}" for x in ENTRY], *[f"T7_{x}" for x in SUPPLIER])
    again = repeat_entries(bronze, p, items).withColumnsRenamed({"DATENT": "T6_DATENT", "DATREI": "A_DATREI"})
    t0 = (t0.alias("T0").join(_technicians(bronze, items, n).alias("T11"), c("T0", "USU_USUTEC") == c("T11", "CODENT"), "left")
            .select("T0.*", c("T11", "NOMCOM").alias("T11_NOMCOM")).join(again, ["T6_DATENT", "USU_SERMAC"], "left").alias("T0"))
    same = c("T0", PRODUCT[0]).eqNullSafe(c("P", PRODUCT[0]))
    for x in PRODUCT[1:]:
        same = same & c("T0", x).eqNullSafe(c("P", x))
    t0 = t0.join(_item_products(bronze, items).alias("P"), same, "left").select("T0.*", *[c("P", x).alias(f"P_{x}") for x in PRODUCT_TEXTS])
    # blank serials match the tracking rows that have a blank code: they are a heavy key here
    serial = ["USU_SERMAC", "USU_CODEMP", "USU_CODFIL"]
    track = bronze("USU_VZRASLAU")
    track = track.select(*[F.col(x).alias(y) for x, y in zip(("USU_CODBAR", "EMPNFV", "FILNFV"), serial)], *[F.col(x).alias(f"T15_{x}") for x in TRACKED])
    t0 = heavy_left_join(t0, keep_members(track, serial, items, expected=n), serial, counted=items, bypass=False).alias("T0")
    j = (t0.join(_report_heads(bronze, items, n).alias("T1"), on("T0", "T1", *HEAD_KEY), "left")
           .join(bronze("USU_TLAUPRB").alias("T5"), c("T0", "USU_CODPRB") == c("T5", "USU_CODPRB"), "left")
           .join(bronze("USU_TLAUCOR").alias("T14"), c("T0", "USU_CODCOR") == c("T14", "USU_CODCOR"), "left")
           .select("T0.*", *[c("T1", x).alias(f"T1_{x}") for x in (*HEAD, *HEAD_TEXTS)],
                   c("T5", "USU_DESPRB").alias("T5_USU_DESPRB"), c("T14", "USU_DESCOR").alias("T14_USU_DESCOR")))
    base = j.select(
        F.col("T6_DATENT").alias("DATENT"), F.col("USU_SERMAC").alias("USU_SERMAC"),
        F.col("USU_CODEMP").alias("USU_CODEMP"), F.col("USU_CODFIL").alias("USU_CODFIL"),
        F.col("USU_CODFOR").alias("USU_CODFOR"), F.col("T7_NOMFOR").alias("NOMFOR"),
        F.col("T7_SIGUFS").alias("SIGUFS"), F.col("T7_CIDFOR").alias("CIDFOR"), F.col("T7_CODCLI").alias("CODCLI"),
        F.col("T7_TIPFOR").alias("TIPFOR"), F.col("T7_FONFOR").alias("FONFOR"), F.col("T7_FONFO2").alias("FONFO2"),
        F.col("T7_FONFO3").alias("FONFO3"), F.col("T7_INTNET").alias("INTNET"),
        F.col("USU_NUMNFC").alias("USU_NUMNFC"), F.col("USU_SEQIPC").alias("USU_SEQIPC"),
        F.col("USU_SEQUNI").alias("USU_SEQUNI"), F.col("T6_USU_DATCON").alias("USU_DATCON"),
        F.col("USU_CODLAU").alias("USU_CODLAU"),
        F.col("T1_USU_TIPLAU").alias("USU_TIPLAU"), F.col("T1_USU_DESTIP").alias("USU_DESTIP"),
        F.col("USU_CODPRO").alias("USU_CODPRO"),
        F.col("USU_CODDER").alias("USU_CODDER"), F.col("P_CODAGT").alias("CODAGT"),
        F.col("P_DESAGP").alias("DESAGP"), F.col("P_CODORI").alias("CODORI"), F.col("P_ORIMER").alias("ORIMER"),
        F.col("USU_CODDEF").alias("USU_CODDEF"), F.col("P_USU_DESDEF").alias("USU_DESDEF"),
        F.col("USU_PECFAL").alias("USU_PECFAL"), F.col("USU_PECTRO").alias("USU_PECTRO"),
        F.col("USU_CODCOR").alias("USU_CODCOR"), F.col("T14_USU_DESCOR").alias("USU_DESCOR"),
        F.col("USU_USUTEC").alias("USU_USUTEC"), F.col("T11_NOMCOM").alias("NOMCOM"),
        F.col("USU_TMPUTI").alias("USU_TMPUTI"), F.col("T1_USU_NUMNFV").alias("USU_NUMNFV"),
        F.col("T1_USU_USUFIN").alias("USU_USUFIN"), F.col("T1_USU_DATALT").alias("USU_DATALT"),
        X.when_in(F.col("T1_USU_CODSIT"), FINISHED_SITUATIONS, F.col("T1_USU_DATSEP")).alias("DATFIN"),
        F.col("USU_OBSCLI").alias("USU_OBSCLI"), F.col("USU_CODPRB").alias("USU_CODPRB"),
        F.col("T5_USU_DESPRB").alias("USU_DESPRB"), F.col("T1_USU_CODSIT").alias("USU_CODSIT"),
        F.col("T1_USU_DESSIT").alias("USU_DESSIT"), F.lit(1).alias("QTDREG"), F.col("T1_DATEMI").alias("DATEMI"),
        F.col("T1_USU_CODRAS").alias("USU_CODRAS"), F.col("T1_USU_ENTCOR").alias("USU_ENTCOR"),
        F.col("T1_CODTRA").alias("CODTRA"), F.col("T1_APETRA").alias("APETRA"), F.col("T15_NUMOCP").alias("NUMOCP"),
        F.col("T15_DATEMIOCP").alias("DATEMIOCP"), F.col("T15_CODFOR").alias("CODFOR"),
        F.col("T15_NOMFOR").alias("NOMFORCOMP"), F.col("T15_USU_NUMINV").alias("USU_NUMINV"),
        F.col("T15_USU_DATEMB").alias("USU_DATEMB"), F.col("T15_NUMNFC").alias("NUMNFC"),
        F.col("T15_DATEMINFC").alias("DATEMINFC"), F.col("A_DATREI").alias("DATREI"))
    as_of = p.as_of
    return base.select(
        "*",
        F.when(F.col("USU_CODPRO").isNull(), F.lit(None).cast("string"))
        .otherwise(F.concat_ws("|", F.col("USU_CODPRO"), X.int_text("USU_CODDEF"))).alias("PROD_COD_DEF"),
        X.pipe_key(F.month("DATENT"), F.year("DATENT"), F.col("USU_CODPRO")).alias("VENDA_MES_ANO_PRODUTO"),
        X.macro_region("SIGUFS").alias("MACRO_REGIAO"),
        X.member_flag("ORIMER", X.IMPORTED_ORIGINS, "Importado", "Nacional").alias("DS_ORIGEM_FISCAL"),
        X.sla_status("DATENT", "DATFIN", as_of).alias("DS_PRAZO"),
        X.sla_days("DATENT", "DATFIN", as_of).alias("DIAS_PRAZO_LAUDO"),
        X.repeat_days("USU_SERMAC", "DATENT", "DATREI").alias("DIAS_REINCIDENCIA"),
        X.repeat_class("USU_SERMAC", "DATENT", "DATREI").alias("REINCIDENTE"),
        X.finish_year_text("DATFIN").alias("DT_ANO_FINALIZ"), F.month("DATFIN").alias("DT_MES_FINALIZ"),
        F.dayofmonth("DATFIN").alias("DT_DIA_FINALIZ"),
        X.delivery_carrier("APETRA").alias("DS_TRANSPORTADORA_ENTREGA"),
        X.delivery_days("USU_ENTCOR", "DATENT").alias("DIAS_ENTREGA"),
        X.delivery_bucket("USU_ENTCOR", "DATENT").alias("DS_CLASSIF_ENTREGA"),
        X.transport_type("APETRA").alias("DS_TIPO_TRANSPORTE"))
