"""OPEX budget (DP-08) and traceability (DP-09) products."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions import exprs as X
from ...sources import sheets
from .common import Bronze, ProductParams, c, on

# Fixed values
OPEX_PLAN = "801"
PRODUCTIVE_CENTRE_TYPES = (1, 2)
TRACE_DEPOSITS = ("EXP", "E-COMMERCE")
TRACE_TRANSACTIONS = ("90100", "90101", "90120", "90170", "90171")


# ---------------------------------------------------------------------------
# DP-08 OPEX budget vs actual
# ---------------------------------------------------------------------------
def opex_budget(bronze: Bronze, p: ProductParams) -> DataFrame:
    """Budget rows (USU_T650ORC) with the actual spend summed from USU_T650CUS.

    Written as the source's FULL OUTER JOIN + WHERE on the budget side, which
    Catalyst turns into a left join.  The actual side is summed per join key
    *before* the join (the group keys of the source query are the budget row's
    own key, so the pre-aggregate gives the same sums and shuffles far less).
    """
    keys = ["USU_CODEMP", "USU_MESANO", "USU_CODMPC", "USU_CTADRE", "USU_CODCCU"]
    actual = bronze("USU_T650CUS").groupBy(*keys).agg(F.sum("USU_SALMES").alias("REALIZADO")).alias("T0")
    t1 = bronze("USU_T650ORC").alias("T1")
    j = (t1.join(actual, on("T0", "T1", *keys), "full")
           .join(bronze("E044CCU").alias("T2"), (c("T1", "USU_CODEMP") == c("T2", "CODEMP"))
                 & (c("T1", "USU_CODCCU") == c("T2", "CODCCU")), "left")
           .join(bronze("R910USU").alias("T4"), c("T2", "USU_CODRES") == c("T4", "CODENT"), "left")
           .join(bronze("R910USU").alias("T5"), c("T2", "USU_CODCOR") == c("T5", "CODENT"), "left")
           .join(bronze("E043PCM").alias("T3"), (c("T1", "USU_CTADRE") == c("T3", "CTARED"))
                 & (c("T1", "USU_CODMPC") == c("T3", "CODMPC")), "left")
           .where(c("T1", "USU_CODEMP").isin(*p.opex_companies) & (c("T1", "USU_CODMPC") == OPEX_PLAN)))
    tp = c("T2", "TIPCCU")
    return j.select(
        c("T1", "USU_CODEMP").alias("EMP"), c("T1", "USU_MESANO").alias("COMP"), c("T1", "USU_CODCCU").alias("CC"),
        c("T1", "USU_CTADRE").alias("CDESP"), c("T1", "USU_ORCMES").alias("ORCADO"),
        c("T0", "REALIZADO").alias("REALIZADO"), c("T2", "DESCCU").alias("CCUSTO"), tp.alias("TPCC"),
        c("T3", "DESCTA").alias("DESPESA"),
        F.when(tp.isin(*PRODUCTIVE_CENTRE_TYPES), "Produtivo").otherwise("Não Produtivo").alias("PROD"),
        c("T2", "USU_CODRES").alias("CODDONO"), c("T4", "NOMCOM").alias("DONO"),
        X.quarter_label(c("T1", "USU_MESANO")).alias("QUARTER"),
        c("T2", "USU_CODCOR").alias("CODCOORD"), c("T5", "NOMCOM").alias("COORD"))


# ---------------------------------------------------------------------------
# DP-09 traceability (bar codes)
# ---------------------------------------------------------------------------
MIX_COLUMNS = {"MIX": "string", "ORIGEM": "string"}


def traceability(bronze: Bronze, p: ProductParams, mix_sheet: DataFrame | None = None) -> DataFrame:
    """Bar-code log joined through notes, customers, reps, products and order
    items; the optional mix sheet (Cd_Item, Cd_Com_Mix, Cd_Com_Ori) adds MIX and
    ORIGEM, and a missing sheet gives NULL columns (SRC-15).  A product listed
    twice in the sheet fans out, as in the source (JON-16): check it with
    :func:`tierwise.operators.merge.key_grain_report`."""
    cut = F.lit(p.trace_cutoff).cast("date")
    ipv = bronze("E140IPV").alias("IPV")
    j = (ipv.join(bronze("E140NFV").alias("NFV"), on("IPV", "NFV", "NUMNFV", "CODSNF", "CODEMP", "CODFIL"))
            .join(bronze("E085CLI").alias("CLI"), c("NFV", "CODCLI") == c("CLI", "CODCLI"))
            .join(bronze("E090REP").alias("REP"), c("NFV", "CODREP") == c("REP", "CODREP"))
            .join(bronze("E026RAM").alias("RAM"), c("REP", "USU_CODRAM") == c("RAM", "CODRAM"))
            .join(bronze("E075PRO").alias("PRO"), on("IPV", "PRO", "CODEMP", "CODPRO"))
            .join(bronze("E120IPD").alias("IPD"), on("IPV", "IPD", "NUMPED", "SEQIPD", "CODEMP", "CODFIL"))
            .join(bronze("USU_T140QRC").alias("QRC"),
                  (c("IPV", "CODEMP") == c("QRC", "USU_CODEMP")) & (c("IPV", "CODFIL") == c("QRC", "USU_CODFIL"))
                  & (c("IPV", "CODSNF") == c("QRC", "USU_CODSNF")) & (c("IPV", "NUMNFV") == c("QRC", "USU_NUMNFV"))
                  & (c("IPV", "SEQIPV") == c("QRC", "USU_SEQIPV")))
            .join(bronze("USU_VZRASLAU").alias("PVD"),
                  (c("QRC", "USU_CODBAR") == c("PVD", "USU_CODBAR")) & (c("QRC", "USU_CODEMP") == c("PVD", "EMPNFV"))
                  & (c("QRC", "USU_CODFIL") == c("PVD", "FILNFV")), "left")
            .where((c("IPV", "CODEMP") == p.company) & (c("IPV", "CODFIL") == p.branch)
                   & c("IPV", "CODDEP").isin(*TRACE_DEPOSITS)
                   & (F.to_date(c("NFV", "DATEMI")) >= cut)          # text-date compare == day compare
                   & c("IPD", "TNSPRO").isin(*TRACE_TRANSACTIONS)
                   & (F.to_date(c("QRC", "USU_DATGER")) >= cut)))
    out = j.select(
        c("IPV", "NUMNFV").alias("NUMNFV"), c("IPV", "NUMPED").alias("NUMPED"), c("IPV", "CODPRO").alias("CODPRO"),
        c("PRO", "DESPRO").alias("DESPRO"), c("IPV", "QTDFAT").alias("QTDFAT"), c("NFV", "CODCLI").alias("CODCLI"),
        c("NFV", "CODREP").alias("CODREP"), c("NFV", "DATEMI").alias("DATEMI"), c("CLI", "NOMCLI").alias("NOMCLI"),
        c("CLI", "APECLI").alias("APECLI"), c("CLI", "TIPCLI").alias("TIPCLI"), c("CLI", "SIGUFS").alias("SIGUFS"),
        c("CLI", "CIDCLI").alias("CIDCLI"), c("CLI", "CODRAM").alias("CODRAM"), c("REP", "NOMREP").alias("NOMREP"),
        c("REP", "APEREP").alias("APEREP"), c("REP", "TIPREP").alias("TIPREP"),
        c("REP", "USU_CODRAM").alias("CANREP"), c("RAM", "DESRAM").alias("DESRAM"),
        c("QRC", "USU_CODBAR").alias("CODBAR"), c("QRC", "USU_DATGER").alias("DATGER"),
        c("PVD", "CODFOR").alias("CODFOR"), c("PVD", "NOMFOR").alias("NOMFOR"), c("PVD", "NUMOCP").alias("NUMOCP"),
        c("PVD", "USU_NUMINV").alias("NUMINV"), c("PVD", "NUMNFC").alias("NUMNFC"),
        c("PVD", "DATEMIOCP").alias("DATOCP"), c("PVD", "USU_DATEMB").alias("DATEMB"),
        c("PVD", "DATEMINFC").alias("DATEMINFC"), c("PVD", "DATENTNFC").alias("DATENTNFC"))
    if mix_sheet is None:
        return out.withColumns({k: F.lit(None).cast(t) for k, t in MIX_COLUMNS.items()})
    mix = sheets.rename_present(mix_sheet, {"Cd_Item": "CODPRO", "Cd_Com_Mix": "MIX", "Cd_Com_Ori": "ORIGEM"}) \
        .select(F.trim(F.col("CODPRO").cast("string")).alias("_K"), F.col("MIX").cast("string").alias("MIX"),
                F.col("ORIGEM").cast("string").alias("ORIGEM"))
    return (out.withColumn("CODPRO", F.trim(F.col("CODPRO").cast("string")))
               .join(mix, F.col("CODPRO") == F.col("_K"), "left").drop("_K"))
