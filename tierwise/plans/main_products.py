"""The four main products (DP-06, DP-07, DP-16, DP-21) over the whole test tables, and
independent SQL for them.

As in ``product_queries``: the test tables are projected whole onto bronze frames, the
product's own builder runs on them, and the SQL states the product's rule anew.
Averages are compared with eight decimals, the scale of Spark's decimal average.
"""

from __future__ import annotations

from dataclasses import replace

from .product_queries import BRONZE, PARAMS, _query, _sql

_ORDER_COMPANY = "CASE WHEN o_orderkey % 17 = 0 THEN 2 ELSE 1 END"
_LINE_COMPANY = "CASE WHEN l_orderkey % 17 = 0 THEN 2 ELSE 1 END"
_ITEM = [("CODPRO", "'' || l_partkey"), ("CODDER", "CASE l_suppkey % 3 WHEN 0 THEN ' ' WHEN 1 THEN NULL ELSE 'D' || (l_suppkey % 5) END"),
         ("CODDEP", "'W' || (l_suppkey % 4)"), ("TNSPRO", "l_returnflag || l_linestatus"), ("PREUNI", "CAST(l_extendedprice AS DECIMAL(18,4))"),
         ("VLRLIQ", "CAST(l_extendedprice AS DECIMAL(18,4))"), ("VLRICM", "CAST(l_discount AS DECIMAL(18,4))"), ("VLRICS", "CAST(l_tax AS DECIMAL(18,4))"),
         ("VLRIPI", "CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE CAST(l_quantity AS DECIMAL(18,4)) END"),
         ("VLROUT", "CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE CAST(l_linenumber AS DECIMAL(18,4)) END"),
         ("PEROFE", "CAST(l_discount AS DECIMAL(18,4))"), ("VLROFE", "CAST(l_tax AS DECIMAL(18,4))")]
_TERMS = [("CODTRA", "'T' || (o_custkey % 5)"), ("CODCPG", "'P' || (o_custkey % 6)"), ("CODFPG", "'F' || (o_custkey % 5)")]
_HEAD = [("CODCLI", "o_custkey"), ("USU_CLIBAS", "CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_custkey + 1 END"),
         ("USU_CODRVRREP", "'' || (o_custkey % 25)"), ("USU_CODRVRCLI", "CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE '' || (o_custkey % 20) END"), *_TERMS]
_STAGE = "'' || (CASE WHEN l_linenumber = 7 THEN 50 ELSE l_linenumber END)"


def _code(table: str, code: str, prefix: str, name: str, *more) -> tuple:
    """A look-up table with one row a nation."""
    return ("nation", False, [(code, f"'{prefix}' || n_nationkey"), (name, "CASE WHEN n_nationkey % 6 = 0 THEN ' ' ELSE lower(n_name) END"), *more])


FRAMES = {**BRONZE, **{
    # notes, customers
    "E001TNS": ("lineitem", True, [
        ("CODEMP", "1"), ("CODTNS", "l_returnflag || l_linestatus"), ("VENFAT", "CASE WHEN l_returnflag = 'R' THEN 'N' ELSE 'S' END"),
        ("CPRTCF", "CASE l_returnflag WHEN 'A' THEN 'D' WHEN 'N' THEN 'A' ELSE 'X' END"),
        ("COMNAT", "CASE l_returnflag || l_linestatus WHEN 'AF' THEN '1202' WHEN 'AO' THEN '1603' WHEN 'NF' THEN '2411' WHEN 'NO' THEN '2603' ELSE '5102' END")]),
    "E140NFV": ("orders", False, [
        ("CODEMP", _ORDER_COMPANY), ("CODFIL", "1"), ("CODSNF", "'S'"), ("NUMNFV", "o_orderkey"), ("DATEMI", "o_orderdate"),
        ("SITNFV", "CASE WHEN o_orderkey % 19 = 0 THEN '1' ELSE '2' END"), ("TIPNFS", "CASE o_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 9 ELSE 2 END"),
        ("TNSPRO", "CASE WHEN o_orderkey % 6 = 0 THEN 'RF' ELSE 'AF' END"), ("CODREP", "o_orderkey % 500"), ("USU_CODRAS", "'R' || o_orderkey"),
        ("USU_ENTCOR", "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderdate + INTERVAL 30 DAY + INTERVAL 7 HOUR END"), *_HEAD]),
    "E140IDE": ("orders", False, [
        ("CODEMP", _ORDER_COMPANY), ("CODFIL", "1"), ("CODSNF", "'S'"), ("NUMNFV", "o_orderkey"), ("SITDOE", "CASE WHEN o_orderkey % 4 = 0 THEN 2 ELSE 3 END")]),
    "E085CLI": ("customer", False, [
        ("CODCLI", "c_custkey"), ("CODGRE", "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE '' || (c_custkey % 30) END"), ("CGCCPF", "'' || (c_custkey * 7919)"),
        ("TIPCLI", "CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'J' END"), ("NOMCLI", "' ' || lower(c_name)"), ("SITCLI", "CASE WHEN c_custkey % 3 = 0 THEN 'A' ELSE 'I' END"),
        ("SIGUFS", "CASE c_nationkey % 3 WHEN 0 THEN 'SP' WHEN 1 THEN 'PR' ELSE NULL END"), ("CIDCLI", "' city ' || c_nationkey"), ("CODRAM", "lower(c_mktsegment)"),
        ("USU_CODRVR", "c_nationkey"), ("DATCAD", "make_date(2000, 1 + c_nationkey % 12, 3)"), ("DATATU", "make_date(2001, 1 + c_nationkey % 12, 4)"),
        ("CLICON", "'N'"), ("ENDCLI", "'street ' || (c_custkey % 90)"), ("NENCLI", "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE '' || (c_custkey % 900) END"),
        ("CPLEND", "CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE 'flat ' || (c_custkey % 9) END"), ("BAICLI", "CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE 'centre' END"),
        ("CEPCLI", "'' || (c_custkey * 37)"), ("FONCLI", "'(' || c_nationkey || ') 5-' || c_custkey"), ("FONCL2", "CASE WHEN c_custkey % 2 = 0 THEN 'none' END"),
        ("INTNET", "'A' || c_custkey || '@X.COM '")]),
    "E069GRE": _code("E069GRE", "CODGRE", "", "NOMGRE", ("CLIBAS", "CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE n_nationkey * 10 + 1 END")),
    "E085HCL": ("customer", False, [
        ("CODCLI", "c_custkey"), ("CODEMP", "CASE WHEN c_custkey % 9 = 0 THEN 2 ELSE 1 END"), ("CODFIL", "CASE WHEN c_custkey % 11 = 0 THEN 2 ELSE 1 END"),
        ("CODREP", "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_custkey + 3 END"), ("CODFPG", "'F' || (c_custkey % 5)"), ("CODCPG", "'P' || (c_custkey % 6)"),
        ("USU_CODPFC", "'' || (c_custkey % 4)"), ("USU_CODMNC", "'' || (c_custkey % 30)"), ("CODTRA", "'T' || (c_custkey % 30)"), ("CONFIN", "'S'"),
        ("LIMAPR", "CASE WHEN c_custkey % 2 = 0 THEN 'S' ELSE 'N' END"), ("DATLIM", "make_date(2001, 1 + c_nationkey % 12, 9)"), ("VLRLIM", "CAST(c_acctbal AS DECIMAL(18,4))")]),
    "USU_TPCRCPC": ("customer", False, [("USU_CODCLI", "c_custkey"), ("USU_CODGRA", "'' || (c_custkey % 30)")]),
    "USU_TPCRCDG": _code("USU_TPCRCDG", "USU_CODGRA", "", "USU_DESGRA"),
    "E066FPG": _code("E066FPG", "CODFPG", "F", "DESFPG", ("CODEMP", "1")),
    "E028CPG": _code("E028CPG", "CODCPG", "P", "DESCPG", ("CODEMP", "1")),
    "USU_TPCAPFC": _code("USU_TPCAPFC", "USU_CODPFC", "", "USU_DSCPFC"),
    "USU_TPCAMNC": _code("USU_TPCAMNC", "USU_CODMNC", "", "USU_DSCMNC"),
    "E073TRA": _code("E073TRA", "CODTRA", "T", "NOMTRA", (
        "APETRA", "CASE n_nationkey WHEN 0 THEN 'CORREIO / SEDEX' WHEN 1 THEN 'RETIRA' WHEN 2 THEN 'TEX COURIER LTDA. EM RECUPERACAO JUDICIAL' ELSE n_name END")),
    # order lines, sold and returned lines
    "E120IPD": ("lineitem", False, [
        *[x for x in _ITEM if x[0] != "TNSPRO"], ("CODEMP", _LINE_COMPANY), ("CODFIL", "1"), ("NUMPED", "l_orderkey"), ("SEQIPD", "l_linenumber"), ("CODREP", "l_suppkey"),
        ("TNSPRO", "CASE l_linenumber % 4 WHEN 0 THEN '90999' WHEN 1 THEN '90100' WHEN 2 THEN '90120' ELSE '90170' END"),
        ("QTDABE", "CAST(l_quantity AS DECIMAL(18,4))"), ("VSTFCP", "CAST(l_linenumber AS DECIMAL(18,4))")]),
    "E120PED": ("orders", False, [
        ("CODEMP", _ORDER_COMPANY), ("CODFIL", "1"), ("NUMPED", "o_orderkey"), ("SITPED", "'' || (1 + o_orderkey % 4)"), ("DATPRV", "o_orderdate + INTERVAL 10 DAY"), *_HEAD]),
    "E140IPV": ("lineitem", False, [
        *_ITEM, ("CODEMP", _LINE_COMPANY), ("CODFIL", "1"), ("CODSNF", "'S'"), ("NUMNFV", "l_orderkey"), ("NUMPED", "l_orderkey + 1"), ("SEQIPV", "l_linenumber"),
        ("DATGER", "l_shipdate"), ("QTDFAT", "CAST(l_quantity AS DECIMAL(18,4))")]),
    "E140ISV": ("lineitem", False, [
        *[x for x in _ITEM if x[0] != "TNSPRO"], ("CODEMP", _LINE_COMPANY), ("CODFIL", "1"), ("CODSNF", "CASE WHEN l_partkey % 5 = 0 THEN 'T' ELSE 'S' END"), ("NUMNFV", "l_orderkey"),
        ("NUMPED", "l_orderkey"), ("SEQIPV", "l_linenumber"), ("SEQISV", "l_linenumber + 100"), ("CODSER", "'S' || (l_suppkey % 9)"), ("TNSSER", "l_returnflag || l_linestatus"),
        ("DATGER", "l_shipdate"), ("QTDFAT", "CAST(l_quantity AS DECIMAL(18,4))")]),
    "E140PVD": ("lineitem", True, [
        ("CODEMP", _LINE_COMPANY), ("CODFIL", "CASE WHEN l_orderkey % 8 = 0 THEN 2 ELSE 1 END"), ("NUMNFV", "l_orderkey"), ("SEQIPV", "l_linenumber"),
        ("VSTFCP", "CAST(l_linenumber + l_orderkey % 5 AS DECIMAL(18,4))")]),
    "E440IPC": ("lineitem", False, [
        *_ITEM, ("CODEMP", _LINE_COMPANY), ("CODFIL", "1"), ("CODFOR", "'' || (l_orderkey % 400)"), ("CODSNF", "CASE WHEN l_linenumber = 3 THEN 'T' ELSE 'S' END"),
        ("NUMNFC", "l_orderkey"), ("NUMNFV", "CASE WHEN l_suppkey % 4 = 0 THEN -1 ELSE l_orderkey END"), ("SNFNFV", "'S'"), ("NUMPED", "l_orderkey"), ("SEQIPC", "l_linenumber"),
        ("QTDREC", "CAST(l_quantity AS DECIMAL(18,4))"), ("VECIPI", "CAST(l_quantity AS DECIMAL(18,4))"),
        ("ICMVFC", "CASE l_partkey % 3 WHEN 0 THEN NULL WHEN 1 THEN CAST(0 AS DECIMAL(18,4)) ELSE CAST(l_tax AS DECIMAL(18,4)) END")]),
    "E440NFC": ("orders", False, [
        ("CODEMP", _ORDER_COMPANY), ("CODFIL", "1"), ("CODFOR", "'' || (o_orderkey % 400)"), ("CODSNF", "'S'"), ("NUMNFC", "o_orderkey"),
        ("SITNFC", "CASE WHEN o_orderkey % 10 = 0 THEN '1' ELSE '2' END"), ("TIPNFE", "CASE o_custkey % 4 WHEN 0 THEN '2' WHEN 1 THEN '3' WHEN 2 THEN '9' ELSE '10' END"),
        ("DATENT", "o_orderdate + INTERVAL 20 DAY"), ("USU_DATCON", "o_orderdate + INTERVAL 21 DAY"), ("USU_MOTDEV", "'' || (o_custkey % 6)"),
        ("VSTFCP", "CAST(720720 * (1 + o_orderkey % 3) AS DECIMAL(18,4))"), *_TERMS]),
    "E095FOR": ("customer", False, [
        ("CODFOR", "'' || c_custkey"), ("CODCLI", "CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_custkey * 2 END"), ("NOMFOR", "c_name"),
        ("SIGUFS", "CASE c_custkey % 5 WHEN 0 THEN 'SP' WHEN 1 THEN 'PR' WHEN 2 THEN 'BA' WHEN 3 THEN 'XX' ELSE NULL END"), ("CIDFOR", "'city ' || c_nationkey"),
        ("TIPFOR", "'J'"), ("FONFOR", "'1'"), ("FONFO2", "'2'"), ("FONFO3", "'3'"), ("INTNET", "'x@y'")]),
    # production
    "E900EOQ": ("lineitem", False, [
        ("CODEMP", "1"), ("CODORI", "'PRO'"), ("NUMORP", "l_orderkey"), ("CODETG", _STAGE), ("SEQROT", "l_linenumber"), ("DATREA", "l_shipdate"),
        ("CODCRE", "'' || (l_partkey % 40)"), ("CODPRO", "'' || (l_orderkey % 50)"), ("CODDER", "' '"), ("CODOPR", "'O' || (l_suppkey % 3)"),
        ("QTDRE1", "CAST(l_quantity AS DECIMAL(18,4))"), ("TMPBRU", "CAST(l_extendedprice AS DECIMAL(18,4))"), ("HORREA", "l_suppkey % 24")]),
    "E900COP": ("orders", False, [
        ("CODEMP", "1"), ("CODORI", "'PRO'"), ("NUMORP", "o_orderkey"), ("CODPRO", "'' || (o_orderkey % 50)"), ("DTRINI", "o_orderdate"),
        ("DTRFIM", "CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE o_orderdate + INTERVAL 40 DAY END"), ("SITORP", "o_orderstatus")]),
    "E900OOP": ("lineitem", True, [
        ("CODEMP", "1"), ("CODORI", "'PRO'"), ("NUMORP", "l_orderkey"), ("CODETG", _STAGE), ("SEQROT", "l_linenumber"), ("CODOPR", "'P' || (l_linenumber % 2)"), ("SFXETR", "'1'"),
        ("SFXSEQ", "CASE WHEN l_orderkey % 13 = 0 THEN '2' ELSE '1' END"), ("TMPPRP", "CAST(60 * (1 + l_orderkey % 7) AS DECIMAL(18,4))"),
        ("UNICRE", "CASE l_orderkey % 5 WHEN 0 THEN 'M' WHEN 1 THEN 'D' WHEN 2 THEN 'H' WHEN 3 THEN 'S' ELSE 'X' END")]),
    "E900QDO": ("orders", False, [
        ("CODEMP", "1"), ("CODORI", "'PRO'"), ("NUMORP", "o_orderkey"), ("CODPRO", "'' || (o_orderkey % 50)"), ("CODDER", "CASE WHEN o_orderkey % 12 = 0 THEN 'D' ELSE ' ' END"),
        ("QTDPRV", "CAST(o_custkey % 90 AS DECIMAL(18,4))"), ("QTDRFG", "CAST(o_custkey % 4 AS DECIMAL(18,4))")]),
    "E630SPE": ("lineitem", False, [
        ("CODEMP", "1"), ("CODORI", "'PRO'"), ("NUMORP", "l_orderkey"), ("CODPRO", "'' || (l_orderkey % 50)"),
        ("CODETG", "CASE l_linenumber WHEN 5 THEN '99' WHEN 7 THEN '50' ELSE '1' END"), ("SDOATU", "CAST(l_quantity AS DECIMAL(18,4))")]),
    "E621MTC": ("supplier", False, [
        ("CODEMP", "1"), ("NUMMTC", "s_suppkey + 1598"), ("TIPMTC", "CASE WHEN s_suppkey % 3 = 0 THEN '31' ELSE '28' END"),
        ("DATINI", "make_date(1997 + s_nationkey % 4, 1 + s_nationkey % 12, 1)"), ("DATFIM", "make_date(1999 + s_suppkey % 4, 1 + s_nationkey % 12, 15)")]),
    "E626TAX": ("supplier", False, [("CODEMP", "1"), ("NUMMTC", "s_suppkey + 1598"), ("CODCCU", "'' || s_nationkey"), ("TAXCUS", "CAST(s_acctbal AS DECIMAL(18,4))")]),
    "E725CRE": ("supplier", False, [("CODEMP", "1"), ("CODCRE", "'' || s_suppkey"), ("CODCCU", "CASE WHEN s_suppkey % 4 = 0 THEN ' ' ELSE '' || s_nationkey END")]),
    "E093ETG": ("nation", False, [("CODEMP", "1"), ("CODETG", "'' || n_nationkey"), ("CODCCU", "'' || (24 - n_nationkey)")]),
    "E044CCU": ("nation", False, [("CODEMP", "1"), ("CODCCU", "'' || n_nationkey")]),
    "E210MVP": ("lineitem", False, [
        ("CODEMP", "1"), ("NUMDOC", "l_orderkey"), ("ORIORP", "'PRO'"), ("CODETG", _STAGE), ("DATMOV", "CASE WHEN l_suppkey % 5 = 0 THEN l_shipdate + INTERVAL 1 DAY ELSE l_shipdate END"),
        ("CODTNS", "CASE l_partkey % 3 WHEN 0 THEN '90251' WHEN 1 THEN '90202' ELSE '90000' END"), ("CODPRO", "'' || l_partkey"),
        ("ESTEOS", "CASE WHEN l_returnflag = 'R' THEN 'E' ELSE 'S' END"), ("QTDMOV", "CAST(l_quantity AS DECIMAL(18,4))"), ("VLRMOV", "CAST(l_extendedprice AS DECIMAL(18,4))")]),
    "E075PRO": ("part", False, [
        ("CODEMP", "1"), ("CODPRO", "'' || p_partkey"), ("TIPPRO", "CASE p_size % 3 WHEN 0 THEN 'P' WHEN 1 THEN 'C' ELSE NULL END"), ("CODFAM", "p_brand"), ("CODORI", "'PRO'"),
        ("ORIMER", "CASE p_size % 4 WHEN 0 THEN '1' WHEN 1 THEN '0' WHEN 2 THEN NULL ELSE '8' END")]),
    "E930MPR": ("lineitem", False, [
        ("CODEMP", "1"), ("CODMTV", "'' || l_suppkey"), ("CODETG", "'' || (l_linenumber * 5)"), ("CODCRE", "'' || (l_partkey % 40)"), ("DATMPR", "l_shipdate"),
        ("HORINI", "l_orderkey % 1440"), ("QTDHOR", "CAST(l_quantity AS DECIMAL(18,4))")]),
    "E018MTV": ("supplier", False, [("CODEMP", "1"), ("CODMTV", "'' || s_suppkey")]),
    "E626ORC": ("lineitem", False, [
        ("CODEMP", "1"), ("CODNTG", "'' || l_partkey"), ("NUMMTC", "l_suppkey + 1598"), ("CODCCU", "'' || (3900 + l_orderkey % 500)"), ("VALVIS", "CAST(l_extendedprice AS DECIMAL(18,4))")]),
    "E047NTG": ("part", False, [("CODEMP", "1"), ("CODNTG", "'' || p_partkey")]),
    # reports
    "USU_TLAUITE": ("lineitem", False, [
        ("USU_CODEMP", _LINE_COMPANY), ("USU_CODFIL", "1"), ("USU_CODFOR", "'' || (l_orderkey % 400)"), ("USU_NUMNFC", "l_orderkey"), ("USU_SEQIPC", "l_linenumber"),
        ("USU_SEQUNI", "l_suppkey"), ("USU_CODLAU", "'' || l_orderkey"),
        ("USU_SERMAC", "CASE WHEN l_suppkey % 3 = 0 THEN ' ' WHEN l_suppkey % 19 = 0 THEN 'S/N' WHEN l_suppkey % 17 = 0 THEN NULL ELSE 'M' || l_partkey END"),
        ("USU_CODPRO", "CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE '' || l_partkey END"), ("USU_CODDER", "CASE WHEN l_suppkey % 2 = 0 THEN ' ' ELSE 'D1' END"),
        ("USU_CODDEF", "CASE l_suppkey % 4 WHEN 0 THEN '7.0' WHEN 1 THEN NULL WHEN 2 THEN ' x1 ' ELSE '' || (l_partkey % 20) END"), ("USU_PECFAL", "'f' || (l_suppkey % 3)"),
        ("USU_PECTRO", "'t' || (l_suppkey % 3)"), ("USU_CODCOR", "'' || (l_suppkey % 30)"), ("USU_USUTEC", "'' || (l_suppkey * 3)"), ("USU_TMPUTI", "CAST(l_quantity AS DECIMAL(18,4))"),
        ("USU_OBSCLI", "'note ' || l_linenumber"), ("USU_CODPRB", "'' || (l_partkey % 30)")]),
    "USU_TLAUGER": ("orders", False, [
        ("USU_CODEMP", _ORDER_COMPANY), ("USU_CODFIL", "1"), ("USU_CODLAU", "'' || o_orderkey"), ("USU_TIPLAU", "'' || (o_custkey % 30)"), ("USU_CODSIT", "'' || (o_orderkey % 9)"),
        ("USU_NUMNFV", "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey + 1 END"), ("USU_USUFIN", "'u' || (o_custkey % 7)"), ("USU_DATALT", "o_orderdate"),
        ("USU_DATSEP", "CASE o_custkey % 4 WHEN 0 THEN o_orderdate + INTERVAL 31 DAY - INTERVAL 5 HOUR WHEN 1 THEN o_orderdate + INTERVAL 60 DAY WHEN 2 THEN make_date(1900, 12, 31) ELSE NULL END")]),
    "USU_TLAUTIP": _code("USU_TLAUTIP", "USU_CODTIP", "", "USU_DESTIP"),
    "USU_TLAUSIT": _code("USU_TLAUSIT", "USU_CODSIT", "", "USU_DESSIT"),
    "USU_TLAUPRB": _code("USU_TLAUPRB", "USU_CODPRB", "", "USU_DESPRB"),
    "USU_TLAUCOR": _code("USU_TLAUCOR", "USU_CODCOR", "", "USU_DESCOR"),
    "USU_TLAUDEF": ("part", False, [
        ("USU_CODEMP", "1"), ("USU_CODPRO", "'' || p_partkey"), ("USU_CODDER", "'D1'"), ("USU_CODDEF", "'' || (p_partkey % 20)"), ("USU_DESDEF", "p_type")]),
    "E075DER": ("part", False, [("CODEMP", "1"), ("CODPRO", "'' || p_partkey"), ("CODDER", "CASE WHEN p_size % 2 = 0 THEN ' ' ELSE 'D1' END"), ("CODAGT", "p_type")]),
    "E013AGP": ("part", True, [("CODEMP", "1"), ("CODAGP", "p_type"), ("DESAGP", "'A ' || p_type"), ("TIPAGP", "CASE WHEN p_type = 'ECONOMY' THEN 'X' ELSE 'T' END")]),
    "R910USU": ("customer", False, [("CODENT", "'' || c_custkey"), ("NOMCOM", "c_name")]),
    "USU_VZRASLAU": ("orders", False, [
        ("USU_CODBAR", "CASE WHEN o_orderkey = 7 THEN ' ' ELSE 'M' || o_orderkey END"), ("EMPNFV", "CASE WHEN o_custkey % 10 = 0 THEN 2 ELSE 1 END"), ("FILNFV", "1"),
        ("NUMOCP", "o_orderkey"), ("DATEMIOCP", "o_orderdate"), ("CODFOR", "o_custkey"), ("NOMFOR", "o_orderpriority"), ("USU_NUMINV", "o_custkey + 1"),
        ("USU_DATEMB", "o_orderdate + INTERVAL 1 DAY"), ("NUMNFC", "o_orderkey + 1"), ("DATEMINFC", "o_orderdate + INTERVAL 2 DAY")]),
}}
MAIN_PARAMS = replace(PARAMS, billing_cutoff="1998-06-15", consumption_reach="1996-01-01", performance_floor="1997-01-01")

MAIN_QUERIES = {
    "dp06_customers": _query("DIM_CLIENTE", FRAMES, MAIN_PARAMS),
    "dp07_billing": _query("FAT_FATURAMENTO", FRAMES, MAIN_PARAMS),
    "dp16_performance": _query("FAT_DESEMPENHO_PRODUCAO", FRAMES, MAIN_PARAMS),
    "dp21_report_items": _query("FAT_LAUDOS", FRAMES, MAIN_PARAMS),
}


def _upper(x: str) -> str:
    return f"NULLIF(trim(upper({x})), '')"


def _doubles(**columns: str) -> str:
    return ", ".join(f"CAST({e} AS DOUBLE) AS {c}" for c, e in columns.items())


def _longs(**columns: str) -> str:
    return ", ".join(f"CAST({e} AS BIGINT) AS {c}" for c, e in columns.items())


def _days(a: str, b: str) -> str:
    return f"CAST(floor((epoch(CAST({a} AS TIMESTAMP)) - epoch(CAST({b} AS TIMESTAMP))) / 86400) AS INTEGER)"


_SOLD = "N.TIPNFS IN (1, 9) AND N.SITNFV = '2' AND T.VENFAT = 'S' AND D.SITDOE = 3"
_NOTE = "N.CODTRA AS CODTRANSP, N.CODCPG, N.CODFPG, N.USU_CODRVRREP AS CODREGREP, N.USU_CODRVRCLI AS CODREGCLI, " + _longs(CODREP="N.CODREP", CODCLIBASE="N.USU_CLIBAS", CODCLI="N.CODCLI")
_MEAN = "CAST(CAST(AVG({}) AS DECIMAL(28,8)) AS DOUBLE)"
_SCALED = "CASE UNICRE WHEN 'D' THEN SUM(TMPPRP) * 1440 WHEN 'H' THEN SUM(TMPPRP) * 60 WHEN 'S' THEN SUM(TMPPRP) / 60 ELSE SUM(TMPPRP) END"
_CENTRE = "CASE WHEN X2.CODCCU = ' ' THEN X1.CODCCU ELSE X2.CODCCU END AS CC_EXE"
_STEP = "q.CODEMP = Z.CODEMP AND q.CODORI = Z.CODORI AND q.NUMORP = Z.NUMORP AND q.CODETG = Z.CODETG AND q.SEQROT = Z.SEQROT AND q.DATREA = Z.DATREA"
_OF_ORDER = "SELECT MAX(r.DATREA) FROM ok r WHERE r.DATREA >= TIMESTAMP '1996-01-01 00:00:00' AND r.CODEMP = T0.CODEMP AND r.CODORI = T0.ORIORP AND r.NUMORP = T0.NUMDOC"
_NOW = "TIMESTAMP '2002-01-01 00:00:00'"

MAIN_ORACLE = {
    "dp06_customers": _sql(
        "E140NFV E001TNS E140IDE E085CLI E069GRE E026RAM E085HCL USU_T017RVR USU_TPCRCPC USU_TPCRCDG E066FPG E028CPG USU_TPCAPFC USU_TPCAMNC E073TRA E090REP", f"""
, s AS (
    SELECT COALESCE(G.CLIBAS, C.CODCLI) AS BASE, CAST(N.DATEMI AS DATE) AS DIA, N.DATEMI, N.NUMNFV, N.CODREP
    FROM E140NFV N JOIN E001TNS T ON T.CODEMP = N.CODEMP AND T.CODTNS = N.TNSPRO JOIN E140IDE I ON I.CODEMP = N.CODEMP AND I.NUMNFV = N.NUMNFV
    JOIN E085CLI C ON C.CODCLI = N.CODCLI LEFT JOIN E069GRE G ON G.CODGRE = C.CODGRE
    WHERE N.CODEMP = 1 AND N.TIPNFS = 1 AND N.SITNFV = '2' AND T.VENFAT = 'S' AND I.SITDOE = 3),
k AS (SELECT *, dense_rank() OVER (PARTITION BY BASE ORDER BY DIA) AS n, row_number() OVER (PARTITION BY BASE ORDER BY DATEMI, NUMNFV) AS a,
             row_number() OVER (PARTITION BY BASE ORDER BY DATEMI DESC, NUMNFV DESC) AS z FROM s),
v AS (SELECT BASE, min(DIA) FILTER (WHERE n = 1) AS d1, min(DIA) FILTER (WHERE n = 2) AS d2, min(DIA) FILTER (WHERE n = 3) AS d3, min(DIA) FILTER (WHERE n = 4) AS d4,
             max(DIA) AS dz, max(CODREP) FILTER (WHERE a = 1) AS ra, max(CODREP) FILTER (WHERE z = 1) AS rz FROM k GROUP BY BASE)
SELECT COALESCE(G.CODGRE, '0') AS COD_GRUPO, COALESCE({_upper('G.NOMGRE')}, 'SEM GRUPO') AS NOME_GRUPO, COALESCE(G.CLIBAS, C.CODCLI) AS CODCLI_BASE,
       lpad(B.CGCCPF, CASE B.TIPCLI WHEN 'F' THEN 11 ELSE 14 END, '0') AS DOC_BASE, {_upper('B.NOMCLI')} AS NOME_BASE, B.SIGUFS AS UF_BASE, {_upper('B.CIDCLI')} AS CIDADE_BASE,
       v.d1 AS DT_PRIMCOMPRA_BASE, v.d2 AS DT_SEGCOMPRA_BASE, v.d3 AS DT_TERCOMPRA_BASE, v.d4 AS DT_QUACOMPRA_BASE, v.ra AS CODREP_ABERTURA, {_upper('RA.NOMREP')} AS REP_ABERTURA,
       v.dz AS DT_ULTCOMPRA_BASE, v.rz AS CODREP_ULTVENDA, {_upper('RZ.NOMREP')} AS REP_ULT_VENDA, C.USU_CODRVR AS COD_REGIONAL, {_upper('V.USU_NOMRVR')} AS NOME_REGIONAL,
       H.CODREP AS CODREP_ATUAL, {_upper('RH.NOMREP')} AS NOME_REP_ATUAL, C.CODCLI AS COD_CLIENTE, lpad(C.CGCCPF, CASE C.TIPCLI WHEN 'F' THEN 11 ELSE 14 END, '0') AS DOC_CLIENTE,
       {_upper('C.NOMCLI')} AS NOME_CLIENTE, CASE C.TIPCLI WHEN 'F' THEN 'PF' ELSE 'PJ' END AS TIPO_CLIENTE, CASE C.SITCLI WHEN 'A' THEN 'ATIVO' ELSE 'INATIVO' END AS STATUS_CLIENTE,
       C.CODRAM AS COD_RAMO_ATIVIDADE, {_upper('M.DESRAM')} AS DESC_RAMO_ATIVIDADE, C.DATCAD AS DT_CADASTRO, C.DATATU AS DT_ULTIMA_ATUALIZACAO,
       MN.USU_CODMNC AS COD_MOD_NEGOCIO, {_upper('MN.USU_DSCMNC')} AS DESC_MOD_NEGOCIO, PF.USU_CODPFC AS COD_PERFIL, {_upper('PF.USU_DSCPFC')} AS DESC_PERFIL,
       GC.USU_CODGRA AS COD_GRADUACAO, {_upper('GD.USU_DESGRA')} AS DESC_GRADUACAO, H.CONFIN AS CONSUMIDOR_FINAL, C.CLICON AS CONTRIBUINTE_ICMS, H.LIMAPR AS LIMITE_APROVADO,
       H.DATLIM AS DT_LIMITE_CREDITO, CAST(H.VLRLIM AS DOUBLE) AS VLR_LIMITE_CREDITO, CP.CODCPG AS COD_COND_PGTO, {_upper('CP.DESCPG')} AS DESC_COND_PGTO,
       FP.CODFPG AS COD_FORMA_PGTO, {_upper('FP.DESFPG')} AS DESC_FORMA_PGTO, {_upper('C.ENDCLI')} AS ENDERECO, {_upper('C.NENCLI')} AS NUMERO, {_upper('C.CPLEND')} AS COMPLEMENTO,
       {_upper('C.BAICLI')} AS BAIRRO, lpad(C.CEPCLI, 8, '0') AS CEP, {_upper('C.CIDCLI')} AS CIDADE_CLIENTE, C.SIGUFS AS UF_CLIENTE,
       trim(upper(concat(C.ENDCLI, ', ', C.NENCLI, ' - ', C.BAICLI, ', ', C.CIDCLI, ', ', C.SIGUFS, ', ', lpad(C.CEPCLI, 8, '0')))) AS ENDERECO_COMPLETO,
       NULLIF(regexp_replace(C.FONCLI, '[^0-9]', '', 'g'), '') AS TELEFONE, NULLIF(regexp_replace(C.FONCL2, '[^0-9]', '', 'g'), '') AS TELEFONE2,
       NULLIF(trim(lower(C.INTNET)), '') AS EMAIL, H.CODTRA AS COD_TRANSPORTADORA, {_upper('TR.NOMTRA')} AS NOME_TRANSPORTADORA
FROM E085CLI C LEFT JOIN E069GRE G ON G.CODGRE = C.CODGRE LEFT JOIN E085CLI B ON B.CODCLI = COALESCE(G.CLIBAS, C.CODCLI) LEFT JOIN E026RAM M ON M.CODRAM = C.CODRAM
LEFT JOIN E085HCL H ON H.CODCLI = C.CODCLI AND H.CODEMP = 1 AND H.CODFIL = 1 LEFT JOIN USU_T017RVR V ON V.USU_CODRVR = C.USU_CODRVR
LEFT JOIN USU_TPCRCPC GC ON GC.USU_CODCLI = C.CODCLI LEFT JOIN USU_TPCRCDG GD ON GD.USU_CODGRA = GC.USU_CODGRA
LEFT JOIN E066FPG FP ON FP.CODEMP = H.CODEMP AND FP.CODFPG = H.CODFPG LEFT JOIN E028CPG CP ON CP.CODEMP = H.CODEMP AND CP.CODCPG = H.CODCPG
LEFT JOIN USU_TPCAPFC PF ON PF.USU_CODPFC = H.USU_CODPFC LEFT JOIN USU_TPCAMNC MN ON MN.USU_CODMNC = H.USU_CODMNC LEFT JOIN E073TRA TR ON TR.CODTRA = H.CODTRA
LEFT JOIN v ON v.BASE = COALESCE(G.CLIBAS, C.CODCLI) LEFT JOIN E090REP RA ON RA.CODREP = v.ra LEFT JOIN E090REP RZ ON RZ.CODREP = v.rz LEFT JOIN E090REP RH ON RH.CODREP = H.CODREP""", FRAMES),
    "dp07_billing": _sql("E120IPD E120PED E140IPV E140IDE E001TNS E140NFV E140PVD E140ISV E440IPC E440NFC E095FOR E085CLI E085HCL E069GRE E090REP", f"""
, dev AS (
    SELECT I.*, N.DATENT, N.CODTRA, N.CODCPG, N.CODFPG, N.USU_MOTDEV, H.CODREP AS HREP, R.USU_CODRVR AS RREG, C.USU_CODRVR AS CREG, NF.USU_CODRVRCLI,
           COALESCE(NF.USU_CLIBAS, G.CLIBAS, C.CODCLI) AS BASE, COALESCE(NF.CODCLI, F.CODCLI) AS CLI,
           CASE WHEN COALESCE(I.ICMVFC, 0) = 0 THEN CAST(N.VSTFCP / I.N_LIN AS DECIMAL(28,10)) ELSE I.ICMVFC END AS FEE
    FROM (SELECT *, COUNT(*) OVER (PARTITION BY CODEMP, CODFIL, CODFOR, CODSNF, NUMNFC) AS N_LIN FROM E440IPC) I
    JOIN E440NFC N ON N.CODEMP = I.CODEMP AND N.CODFIL = I.CODFIL AND N.CODSNF = I.SNFNFV AND N.NUMNFC = I.NUMNFC AND N.CODFOR = I.CODFOR
    JOIN E001TNS T ON T.CODEMP = I.CODEMP AND T.CODTNS = I.TNSPRO
    LEFT JOIN E140NFV NF ON NF.CODEMP = I.CODEMP AND NF.CODFIL = I.CODFIL AND NF.CODSNF = I.SNFNFV AND NF.NUMNFV = I.NUMNFV
    LEFT JOIN E095FOR F ON F.CODFOR = I.CODFOR LEFT JOIN E085CLI C ON C.CODCLI = F.CODCLI
    LEFT JOIN E085HCL H ON H.CODEMP = I.CODEMP AND H.CODFIL = I.CODFIL AND H.CODCLI = F.CODCLI LEFT JOIN E069GRE G ON G.CODGRE = C.CODGRE LEFT JOIN E090REP R ON R.CODREP = H.CODREP
    WHERE N.CODEMP = 1 AND N.SITNFC = '2' AND T.CPRTCF IN ('D', 'A') AND N.DATENT >= TIMESTAMP '1998-06-15 00:00:00'
      AND ((T.COMNAT IN ('1201', '2201', '1202', '2202', '1203', '2203', '1503', '2503', '1410', '2410', '1411', '2411') AND N.TIPNFE IN ('2', '3'))
           OR (T.COMNAT IN ('1603', '2603') AND N.TIPNFE IN ('9', '10'))))
SELECT CAST(P.DATPRV AS DATE) AS DATAREF, 'PED' AS TIPOREG, 0 AS VENDA, CASE WHEN I.CODDER = ' ' THEN I.CODPRO || '-' ELSE concat(I.CODPRO, '-', I.CODDER) END AS CHAVE_ITEM,
       I.CODDEP, P.CODTRA AS CODTRANSP, P.CODCPG, P.CODFPG, '0' AS MOTIVODEV, P.USU_CODRVRREP AS CODREGREP, P.USU_CODRVRCLI AS CODREGCLI,
       {_longs(CODFILIAL="I.CODFIL", CODCLIBASE="P.USU_CLIBAS", CODCLI="P.CODCLI", NUMPED="I.NUMPED", NUMNFV="0", NUMNFD="0", CODREP="I.CODREP", SEQIPD="I.SEQIPD")},
       {_doubles(QTDITEM="I.QTDABE", PRECOUNIT="I.PREUNI", VLR_LIQ="I.VLRLIQ", PERC_OFF="I.PEROFE", VLR_OFF="I.VLROFE", VLR_IPI="I.VLRIPI", VLR_ICMS="I.VLRICM", VLR_ST="I.VLRICS",
                 VLR_FUNDPOB="I.VSTFCP", VLR_OUT="I.VLROUT", VLR_SLI="I.VLRLIQ - (I.VLRIPI + I.VLRICS + I.VSTFCP + I.VLROUT)", VLRBRUTO_TOTAL="I.QTDABE * I.PREUNI", VLRDESC_TOTAL="I.QTDABE * I.VLROFE")}
FROM E120IPD I JOIN E120PED P ON P.CODEMP = I.CODEMP AND P.CODFIL = I.CODFIL AND P.NUMPED = I.NUMPED
WHERE I.CODEMP = 1 AND P.SITPED IN ('1', '2') AND I.TNSPRO IN ('90100', '90101', '90120', '90170') AND P.DATPRV >= TIMESTAMP '1998-06-15 00:00:00'
UNION ALL BY NAME
SELECT CAST(I.DATGER AS DATE) AS DATAREF, 'VENPRO' AS TIPOREG, 1 AS VENDA, CASE WHEN I.CODDER = ' ' THEN I.CODPRO ELSE concat(I.CODPRO, '-', I.CODDER) END AS CHAVE_ITEM,
       I.CODDEP, '0' AS MOTIVODEV, {_NOTE}, {_longs(CODFILIAL="I.CODFIL", NUMPED="I.NUMPED", NUMNFV="I.NUMNFV", NUMNFD="0", SEQIPV="I.SEQIPV")},
       {_doubles(QTDITEM="I.QTDFAT", PRECOUNIT="I.PREUNI", VLR_LIQ="I.VLRLIQ", PERC_OFF="I.PEROFE", VLR_OFF="I.VLROFE", VLR_IPI="I.VLRIPI", VLR_ICMS="I.VLRICM", VLR_ST="I.VLRICS",
                 VLR_FUNDPOB="V.VSTFCP", VLR_OUT="I.VLROUT", VLR_SLI="I.VLRLIQ - (I.VLRIPI + I.VLRICS + V.VSTFCP + I.VLROUT)", VLRBRUTO_TOTAL="I.QTDFAT * I.PREUNI", VLRDESC_TOTAL="I.QTDFAT * I.VLROFE")}
FROM E140IPV I JOIN E140IDE D ON D.CODEMP = I.CODEMP AND D.CODFIL = I.CODFIL AND D.NUMNFV = I.NUMNFV JOIN E001TNS T ON T.CODEMP = I.CODEMP AND T.CODTNS = I.TNSPRO
JOIN E140NFV N ON N.CODEMP = I.CODEMP AND N.CODFIL = I.CODFIL AND N.NUMNFV = I.NUMNFV
LEFT JOIN E140PVD V ON V.CODEMP = I.CODEMP AND V.CODFIL = I.CODFIL AND V.NUMNFV = I.NUMNFV AND V.SEQIPV = I.SEQIPV
WHERE I.CODEMP = 1 AND {_SOLD} AND I.DATGER >= TIMESTAMP '1998-06-15 00:00:00'
UNION ALL BY NAME
SELECT CAST(I.DATGER AS DATE) AS DATAREF, 'VENSER' AS TIPOREG, 1 AS VENDA, I.CODSER AS CHAVE_ITEM, '0' AS MOTIVODEV, {_NOTE},
       {_longs(CODFILIAL="I.CODFIL", NUMPED="I.NUMPED", NUMNFV="I.NUMNFV", NUMNFD="0", SEQISV="I.SEQISV")},
       {_doubles(QTDITEM="I.QTDFAT", PRECOUNIT="I.PREUNI", VLR_LIQ="I.VLRLIQ", PERC_OFF="0", VLR_OFF="0", VLR_IPI="COALESCE(I.VLRIPI, 0)", VLR_ICMS="I.VLRICM", VLR_ST="I.VLRICS",
                 VLR_FUNDPOB="COALESCE(V.VSTFCP, 0)", VLR_OUT="I.VLROUT", VLR_SLI="I.VLRLIQ - (COALESCE(I.VLRIPI, 0) + I.VLRICS + COALESCE(V.VSTFCP, 0) + COALESCE(I.VLROUT, 0))",
                 VLRBRUTO_TOTAL="I.QTDFAT * I.PREUNI", VLRDESC_TOTAL="0")}
FROM E140ISV I JOIN E140IDE D ON D.CODEMP = I.CODEMP AND D.CODFIL = I.CODFIL AND D.CODSNF = I.CODSNF AND D.NUMNFV = I.NUMNFV JOIN E001TNS T ON T.CODEMP = I.CODEMP AND T.CODTNS = I.TNSSER
JOIN E140NFV N ON N.CODEMP = I.CODEMP AND N.CODFIL = I.CODFIL AND N.CODSNF = I.CODSNF AND N.NUMNFV = I.NUMNFV
LEFT JOIN E140PVD V ON V.CODEMP = I.CODEMP AND V.CODFIL = I.CODFIL AND V.NUMNFV = I.NUMNFV AND V.SEQIPV = I.SEQIPV
WHERE I.CODEMP = 1 AND {_SOLD} AND I.DATGER >= TIMESTAMP '1998-06-15 00:00:00'
UNION ALL BY NAME
SELECT CAST(DATENT AS DATE) AS DATAREF, 'DEV' AS TIPOREG, 0 AS VENDA, CASE WHEN CODDER = ' ' THEN concat(CODPRO, '-', CODFIL) ELSE concat(CODPRO, '-', CODDER, CODFIL) END AS CHAVE_ITEM,
       CODDEP, CODTRA AS CODTRANSP, CODCPG, CODFPG, USU_MOTDEV AS MOTIVODEV, CAST(RREG AS VARCHAR) AS CODREGREP, COALESCE(USU_CODRVRCLI, CAST(CREG AS VARCHAR)) AS CODREGCLI,
       {_longs(CODFILIAL="CODFIL", CODCLIBASE="BASE", CODCLI="CLI", NUMPED="NUMPED", NUMNFV="NUMNFV", NUMNFD="NUMNFC", CODREP="HREP", SEQIPC="SEQIPC")},
       {_doubles(QTDITEM="-QTDREC", PRECOUNIT="-PREUNI", VLR_LIQ="-VLRLIQ", PERC_OFF="0", VLR_OFF="0", VLR_IPI="-VECIPI", VLR_ICMS="-VLRICM", VLR_ST="-VLRICS", VLR_FUNDPOB="-FEE",
                 VLR_OUT="-VLROUT", VLR_SLI="-(VLRLIQ - (VECIPI + VLRICS + FEE + VLROUT))", VLRBRUTO_TOTAL="-(QTDREC * PREUNI)", VLRDESC_TOTAL="0")}
FROM dev""", FRAMES),
    "dp16_performance": _sql("E900EOQ E900COP E900OOP E093ETG E725CRE E900QDO E630SPE E621MTC E626TAX E210MVP E075PRO E930MPR E018MTV E044CCU E626ORC E047NTG", f"""
, b1 AS (
    SELECT Z.CODEMP, Z.DATREA, Z.NUMORP, Z.CODETG, Z.CODCRE, {_CENTRE}, T2.CODOPR, Z.CODORI, Z.CODPRO, T2.UNICRE, T3.QTDPRV, T3.QTDRFG, T2.TMPPRP, T0.SITORP, T0.DTRINI, T0.DTRFIM, T2.CODEMP AS E2,
           (SELECT SUM(q.QTDRE1) FROM E900EOQ q WHERE {_STEP}) AS MADE, (SELECT SUM(q.TMPBRU) FROM E900EOQ q WHERE {_STEP} AND q.CODOPR = Z.CODOPR) AS GROSS,
           (SELECT SUM(s.SDOATU) FROM E630SPE s WHERE s.CODEMP = T0.CODEMP AND s.CODORI = T0.CODORI AND s.NUMORP = T0.NUMORP AND s.CODPRO = T0.CODPRO AND s.CODETG IN ('99', '50')) AS SDO
    FROM E900EOQ Z JOIN E900COP T0 ON T0.CODEMP = Z.CODEMP AND T0.CODORI = Z.CODORI AND T0.NUMORP = Z.NUMORP
    LEFT JOIN E900OOP T2 ON T2.CODEMP = Z.CODEMP AND T2.CODORI = Z.CODORI AND T2.NUMORP = Z.NUMORP AND T2.CODETG = Z.CODETG AND T2.SEQROT = Z.SEQROT AND T2.SFXETR = '1' AND T2.SFXSEQ = '1'
    LEFT JOIN E093ETG X1 ON X1.CODEMP = Z.CODEMP AND X1.CODETG = Z.CODETG LEFT JOIN E725CRE X2 ON X2.CODEMP = Z.CODEMP AND X2.CODCRE = Z.CODCRE
    LEFT JOIN E900QDO T3 ON T3.CODEMP = Z.CODEMP AND T3.CODORI = Z.CODORI AND T3.NUMORP = Z.NUMORP AND T3.CODPRO = Z.CODPRO AND T3.CODDER = Z.CODDER
    WHERE Z.DATREA > TIMESTAMP '1997-01-01 00:00:00' AND Z.CODETG NOT IN ('99', '50') AND T0.DTRINI >= TIMESTAMP '1999-06-15 00:00:00'),
rated AS (
    SELECT b1.*, COALESCE((SELECT SUM(Y1.TAXCUS) FROM E621MTC Y0 JOIN E626TAX Y1 ON Y1.CODEMP = Y0.CODEMP AND Y1.NUMMTC = Y0.NUMMTC
                           WHERE Y0.TIPMTC = '28' AND Y0.CODEMP = b1.E2 AND Y1.CODCCU = b1.CC_EXE AND b1.DATREA >= Y0.DATINI AND b1.DATREA <= Y0.DATFIM), 0) AS RATE
    FROM b1),
ok AS (SELECT * FROM E900EOQ WHERE HORREA > 0 AND CODETG NOT IN ('99', '50')),
b2 AS (
    SELECT T0.CODEMP, T0.NUMDOC AS NUMORP, T0.DATMOV, {_CENTRE}, T0.CODETG, T3.CODCRE, T0.ORIORP AS CODORI, T2.CODPRO, T0.CODPRO AS PROCON, T1.TIPPRO AS TIPCON, T1.CODFAM, T0.QTDMOV,
           CASE WHEN T0.ESTEOS = 'S' THEN T0.VLRMOV ELSE -T0.VLRMOV END AS COST, COALESCE(({_OF_ORDER} AND r.DATREA = T0.DATMOV), ({_OF_ORDER})) AS DATREA,
           (SELECT SUM(r.QTDRE1) FROM ok r WHERE r.CODEMP = T3.CODEMP AND r.CODORI = T3.CODORI AND r.NUMORP = T3.NUMORP AND r.CODETG = T3.CODETG AND r.SEQROT = T3.SEQROT
             AND date_trunc('month', r.DATREA) = date_trunc('month', T0.DATMOV)) AS TOP
    FROM E210MVP T0 LEFT JOIN E075PRO T1 ON T1.CODEMP = T0.CODEMP AND T1.CODPRO = T0.CODPRO
    LEFT JOIN E900COP T2 ON T2.CODEMP = T0.CODEMP AND T2.NUMORP = T0.NUMDOC AND T2.CODORI = T0.ORIORP
    LEFT JOIN (SELECT DISTINCT CODEMP, CODORI, NUMORP, CODETG, DATREA, CODCRE, SEQROT FROM ok) T3
      ON T3.CODEMP = T0.CODEMP AND T3.CODORI = T0.ORIORP AND T3.NUMORP = T0.NUMDOC AND T3.CODETG = T0.CODETG AND T3.DATREA = T0.DATMOV
    LEFT JOIN E093ETG X1 ON X1.CODEMP = T0.CODEMP AND X1.CODETG = T0.CODETG LEFT JOIN E725CRE X2 ON X2.CODEMP = T0.CODEMP AND X2.CODCRE = T3.CODCRE
    WHERE T0.DATMOV >= TIMESTAMP '1999-06-15 00:00:00' AND T0.CODTNS IN ('90251', '90202') AND T0.CODETG NOT IN ('99', '50'))
SELECT 1 AS TIPTAB, 'DESEMPENHO' AS DESTAB, {_longs(CODEMP="CODEMP", NUMORP="NUMORP")}, DATREA, CC_EXE, CODOPR, CODETG, CODCRE, CODORI, CODPRO,
       {_doubles(QTDPRV="SUM(QTDPRV)", QTDRFG="SUM(QTDRFG)", TMPPRP=_SCALED, TMPPRV=f"({_SCALED}) * SUM(QTDPRV)", TMPLIQ="NULL")}, {_MEAN.format("MADE")} AS QTDREA,
       {_MEAN.format("CASE WHEN month(DTRFIM) = month(DATREA) THEN 0 ELSE SDO END")} AS QTDAND, {_MEAN.format("GROSS")} AS TMPBRU, {_MEAN.format("RATE")} AS TAXREA,
       'Processo' AS TIPCUS, MAX(SITORP) AS SITORP, MAX(DTRINI) AS DTRINI, MAX(DTRFIM) AS DTRFIM
FROM rated GROUP BY CODEMP, DATREA, NUMORP, CODETG, CODCRE, CC_EXE, CODOPR, CODORI, CODPRO, UNICRE
UNION ALL BY NAME
SELECT 2 AS TIPTAB, 'CONSUMO' AS DESTAB, {_longs(CODEMP="CODEMP", NUMORP="NUMORP")}, DATMOV, MAX(DATREA) AS DATREA, CC_EXE, ' ' AS CODOPR, CODETG, CODCRE, CODORI, CODPRO, PROCON, TIPCON,
       {_MEAN.format("TOP")} AS QTDTOP, {_doubles(QTDCOR="SUM(QTDMOV)", CUSMOV="SUM(COST)")}, 'Consumo' AS TIPCUS, CODFAM, CASE TIPCON WHEN 'P' THEN 'CO' ELSE 'MP' END AS CD_TIPO_MP_PERSONALIZADO
FROM b2 GROUP BY CODEMP, NUMORP, DATMOV, CC_EXE, CODETG, CODCRE, CODORI, CODPRO, PROCON, TIPCON, CODFAM
UNION ALL BY NAME
SELECT 3 AS TIPTAB, 'PARADAS' AS DESTAB, {_longs(CODEMP="T0.CODEMP", HORINI="T0.HORINI")}, T0.DATMPR AS DATREA, T2.CODCCU AS CC_EXE, ' ' AS CODOPR, T0.CODETG, T0.CODCRE, ' ' AS CODORI, ' ' AS CODPRO,
       CAST(T0.QTDHOR AS DOUBLE) AS QTDHOR
FROM E930MPR T0 LEFT JOIN E018MTV T1 ON T1.CODEMP = T0.CODEMP AND T1.CODMTV = T0.CODMTV LEFT JOIN E093ETG T2 ON T2.CODEMP = T0.CODEMP AND T2.CODETG = T0.CODETG
LEFT JOIN E044CCU T3 ON T3.CODEMP = T0.CODEMP AND T3.CODCCU = T2.CODCCU WHERE T0.DATMPR > TIMESTAMP '1999-06-15 00:00:00'
UNION ALL BY NAME
SELECT 4 AS TIPTAB, 'CUSTO_CC' AS DESTAB, {_longs(CODEMP="T0.CODEMP", NUMMTC="T0.NUMMTC")}, CAST(T2.DATINI AS TIMESTAMP) AS DATREA, T0.CODCCU AS CC_EXE, ' ' AS CODOPR, ' ' AS CODCRE, ' ' AS CODORI, ' ' AS CODPRO,
       T0.CODNTG, CAST(T0.VALVIS AS DOUBLE) AS VALVIS
FROM E626ORC T0 LEFT JOIN E047NTG T1 ON T1.CODEMP = T0.CODEMP AND T1.CODNTG = T0.CODNTG JOIN E621MTC T2 ON T2.CODEMP = T0.CODEMP AND T2.NUMMTC = T0.NUMMTC
WHERE T0.CODCCU > '4000' AND T0.CODCCU < '4300' AND T0.NUMMTC > 1600 AND T2.DATINI >= DATE '1999-06-15'""", FRAMES),
    "dp21_report_items": _sql(
        "USU_TLAUITE USU_TLAUGER USU_TLAUTIP USU_TLAUDEF USU_TLAUSIT USU_TLAUPRB USU_TLAUCOR E440NFC E095FOR E075PRO E075DER E013AGP R910USU E140NFV E073TRA USU_VZRASLAU", f"""
, pairs AS (
    SELECT DISTINCT N.DATENT, I.USU_SERMAC FROM USU_TLAUITE I JOIN E440NFC N ON N.CODEMP = I.USU_CODEMP AND N.CODFIL = I.USU_CODFIL AND N.CODFOR = I.USU_CODFOR AND N.NUMNFC = I.USU_NUMNFC
    WHERE N.DATENT > TIMESTAMP '2000-01-01 00:00:00' AND I.USU_SERMAC <> ' '),
again AS (SELECT a.DATENT, a.USU_SERMAC, MAX(b.DATENT) AS DATREI FROM pairs a LEFT JOIN pairs b ON b.USU_SERMAC = a.USU_SERMAC AND b.DATENT < a.DATENT GROUP BY 1, 2),
j AS (
    SELECT T0.USU_CODEMP, T0.USU_CODFIL, T0.USU_CODFOR, T7.NOMFOR, T7.SIGUFS, T7.CIDFOR, T7.CODCLI, T7.TIPFOR, T7.FONFOR, T7.FONFO2, T7.FONFO3, T7.INTNET, T0.USU_NUMNFC, T0.USU_SEQIPC, T0.USU_SEQUNI,
           T6.USU_DATCON, T6.DATENT, T0.USU_CODLAU, T1.USU_TIPLAU, T2.USU_DESTIP, T0.USU_SERMAC, T0.USU_CODPRO, T0.USU_CODDER, T9.CODAGT, T10.DESAGP, T8.CODORI, T8.ORIMER, T0.USU_CODDEF, T3.USU_DESDEF,
           T0.USU_PECFAL, T0.USU_PECTRO, T0.USU_CODCOR, T14.USU_DESCOR, T0.USU_USUTEC, T11.NOMCOM, CAST(T0.USU_TMPUTI AS DOUBLE) AS USU_TMPUTI, T1.USU_NUMNFV, T1.USU_USUFIN, T1.USU_DATALT,
           CASE WHEN T1.USU_CODSIT IN ('3', '4', '5', '6', '8') THEN T1.USU_DATSEP END AS DATFIN, T0.USU_OBSCLI, T0.USU_CODPRB, T5.USU_DESPRB, T1.USU_CODSIT, T4.USU_DESSIT, 1 AS QTDREG,
           T12.DATEMI, T12.USU_CODRAS, T12.USU_ENTCOR, T12.CODTRA, T13.APETRA, T15.NUMOCP, T15.DATEMIOCP, T15.CODFOR, T15.NOMFOR AS NOMFORCOMP, T15.USU_NUMINV, T15.USU_DATEMB, T15.NUMNFC, T15.DATEMINFC, A.DATREI
    FROM USU_TLAUITE T0 JOIN E440NFC T6 ON T6.CODEMP = T0.USU_CODEMP AND T6.CODFIL = T0.USU_CODFIL AND T6.CODFOR = T0.USU_CODFOR AND T6.NUMNFC = T0.USU_NUMNFC
    LEFT JOIN USU_TLAUGER T1 ON T1.USU_CODLAU = T0.USU_CODLAU AND T1.USU_CODEMP = T0.USU_CODEMP AND T1.USU_CODFIL = T0.USU_CODFIL LEFT JOIN USU_TLAUTIP T2 ON T2.USU_CODTIP = T1.USU_TIPLAU
    LEFT JOIN USU_TLAUDEF T3 ON T3.USU_CODEMP = T0.USU_CODEMP AND T3.USU_CODPRO = T0.USU_CODPRO AND T3.USU_CODDER = T0.USU_CODDER AND T3.USU_CODDEF = T0.USU_CODDEF
    LEFT JOIN USU_TLAUSIT T4 ON T4.USU_CODSIT = T1.USU_CODSIT LEFT JOIN USU_TLAUPRB T5 ON T5.USU_CODPRB = T0.USU_CODPRB LEFT JOIN E095FOR T7 ON T7.CODFOR = T0.USU_CODFOR
    LEFT JOIN E075PRO T8 ON T8.CODEMP = T0.USU_CODEMP AND T8.CODPRO = T0.USU_CODPRO LEFT JOIN E075DER T9 ON T9.CODEMP = T0.USU_CODEMP AND T9.CODPRO = T0.USU_CODPRO AND T9.CODDER = T0.USU_CODDER
    LEFT JOIN E013AGP T10 ON T10.CODEMP = T9.CODEMP AND T10.CODAGP = T9.CODAGT AND T10.TIPAGP = 'T' LEFT JOIN R910USU T11 ON T11.CODENT = T0.USU_USUTEC
    LEFT JOIN E140NFV T12 ON T12.CODEMP = T1.USU_CODEMP AND T12.CODFIL = T1.USU_CODFIL AND T12.NUMNFV = T1.USU_NUMNFV LEFT JOIN E073TRA T13 ON T13.CODTRA = T12.CODTRA
    LEFT JOIN USU_TLAUCOR T14 ON T14.USU_CODCOR = T0.USU_CODCOR
    LEFT JOIN USU_VZRASLAU T15 ON T15.USU_CODBAR = T0.USU_SERMAC AND T15.EMPNFV = T0.USU_CODEMP AND T15.FILNFV = T0.USU_CODFIL
    LEFT JOIN again A ON A.DATENT = T6.DATENT AND A.USU_SERMAC = T0.USU_SERMAC
    WHERE T6.DATENT >= TIMESTAMP '2000-01-01 00:00:00'),
n AS (SELECT *, {_days("DATFIN", "DATENT")} AS DONE, {_days(_NOW, "DATENT")} AS OPEN, {_days("USU_ENTCOR", "DATENT")} AS WAY, {_days("DATENT", "DATREI")} AS GAP,
             USU_SERMAC IS NULL OR USU_SERMAC IN (' ', 'S/N', 'SN') AS BAD FROM j)
SELECT * EXCLUDE (DONE, OPEN, WAY, GAP, BAD),
       USU_CODPRO || '|' || CASE WHEN USU_CODDEF IS NULL THEN '' WHEN TRY_CAST(trim(USU_CODDEF) AS DOUBLE) IS NOT NULL THEN split_part(trim(USU_CODDEF), '.', 1) ELSE trim(USU_CODDEF) END AS PROD_COD_DEF,
       month(DATENT) || '|' || year(DATENT) || '|' || USU_CODPRO AS VENDA_MES_ANO_PRODUTO, CASE SIGUFS WHEN 'SP' THEN 'Sudeste' WHEN 'PR' THEN 'Sul' WHEN 'BA' THEN 'Nordeste' END AS MACRO_REGIAO,
       CASE WHEN ORIMER IN ('1', '6', '3', '8', '7') THEN 'Importado' ELSE 'Nacional' END AS DS_ORIGEM_FISCAL,
       CASE WHEN DATFIN IS NULL THEN CASE WHEN OPEN > 10 THEN 'Em Aberto Atrasado' ELSE 'Em Aberto no Prazo' END WHEN DONE <= 10 THEN 'Finalizado no Prazo' ELSE 'Finalizado em Atraso' END AS DS_PRAZO,
       COALESCE(DONE, OPEN) AS DIAS_PRAZO_LAUDO, CASE WHEN BAD OR DATREI IS NULL THEN 0 ELSE GAP END AS DIAS_REINCIDENCIA,
       CASE WHEN BAD THEN 2 WHEN DATREI IS NULL OR GAP > 180 THEN 0 ELSE 1 END AS REINCIDENTE,
       CASE WHEN DATFIN IS NULL OR CAST(DATFIN AS DATE) = DATE '1900-12-31' THEN 'Sem Data' ELSE '' || year(DATFIN) END AS DT_ANO_FINALIZ, month(DATFIN) AS DT_MES_FINALIZ, day(DATFIN) AS DT_DIA_FINALIZ,
       CASE WHEN APETRA IN ('TEX COURIER LTDA. EM RECUPERACAO JUDICIAL', 'CORREIO / SEDEX') THEN APETRA END AS DS_TRANSPORTADORA_ENTREGA, CASE WHEN WAY >= 0 THEN WAY END AS DIAS_ENTREGA,
       CASE WHEN WAY > 30 THEN 'Maior que 30 Dias' WHEN WAY > 20 THEN 'Entre 21 e 30 Dias' WHEN WAY > 10 THEN 'Entre 11 e 20 Dias' WHEN WAY > 0 THEN 'Entre 0 e 10 Dias' ELSE 'Sem Data' END AS DS_CLASSIF_ENTREGA,
       CASE WHEN APETRA IS NULL THEN 'Sem NFSaída' WHEN APETRA = 'CORREIO / SEDEX' THEN 'Correios' WHEN APETRA = 'RETIRA' THEN 'Retirada' ELSE 'Transportadoras' END AS DS_TIPO_TRANSPORTE
FROM n""", FRAMES),
}
