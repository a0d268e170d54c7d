"""Catalog of the bronze tables: one ``TableSpec`` per (area, table).

Keys, audit column (with fallback or sentinel), scope and owner of every table the
silver products read.  Two tables have two writers (each area owns its own
slice), so there are 69 entries for 67 distinct tables.
"""

from __future__ import annotations

from .catalog import Catalog, TableSpec

# Companies in scope per area (fixed values of the source configuration).
AREA_COMPANIES = {"opex": (1, 50)}
DEFAULT_COMPANIES = (1,)
BRANCHES = (1,)

# (area, table, keys, audit, fallback, sentinel, company column, branch column)
ENTRIES = [
    ('comercial', 'E120IPD', ('CODEMP', 'CODFIL', 'NUMPED', 'SEQIPD'), 'DATGER', None, None, 'CODEMP', None),
    ('comercial', 'E120PED', ('CODEMP', 'CODFIL', 'NUMPED'), 'DATGER', None, None, 'CODEMP', None),
    ('comercial', 'E140IPV', ('CODEMP', 'CODFIL', 'CODSNF', 'NUMNFV', 'SEQIPV'), 'DATGER', None, None, 'CODEMP', None),
    ('comercial', 'E140ISV', ('CODEMP', 'CODFIL', 'CODSNF', 'NUMNFV', 'SEQISV'), 'DATGER', None, None, 'CODEMP', None),
    ('comercial', 'E140NFV', ('CODEMP', 'CODFIL', 'CODSNF', 'NUMNFV'), 'DATGER', None, None, 'CODEMP', None),
    ('comercial', 'E440IPC', ('CODEMP', 'CODFIL', 'CODFOR', 'NUMNFC', 'CODSNF', 'SEQIPC'), 'DATGER', None, None, 'CODEMP', None),
    ('comercial', 'E440NFC', ('CODEMP', 'CODFIL', 'CODFOR', 'NUMNFC', 'CODSNF'), 'DATGER', None, None, 'CODEMP', None),
    ('comercial', 'E001TNS', ('CODEMP', 'CODTNS'), None, None, None, 'CODEMP', None),
    ('comercial', 'E012FAM', ('CODEMP', 'CODFAM'), None, None, None, 'CODEMP', None),
    ('comercial', 'E013AGP', ('CODEMP', 'CODAGP'), None, None, None, 'CODEMP', None),
    ('comercial', 'E028CPG', ('CODEMP', 'CODCPG'), 'DATATU', 'DATGER', None, 'CODEMP', None),
    ('comercial', 'E066FPG', ('CODEMP', 'CODFPG'), None, None, None, 'CODEMP', None),
    ('comercial', 'E075DER', ('CODEMP', 'CODPRO', 'CODDER'), None, None, None, 'CODEMP', None),
    ('comercial', 'E075PRO', ('CODEMP', 'CODPRO'), None, None, None, 'CODEMP', None),
    ('comercial', 'E085HCL', ('CODCLI', 'CODEMP', 'CODFIL'), None, None, None, 'CODEMP', None),
    ('comercial', 'E140IDE', ('CODEMP', 'CODFIL', 'CODSNF', 'NUMNFV'), None, None, None, 'CODEMP', None),
    ('comercial', 'E140PVD', ('CODEMP', 'CODFIL', 'CODSNF', 'NUMNFV', 'SEQIPV'), None, None, None, 'CODEMP', None),
    ('comercial', 'E022CLF', ('CODCLF',), None, None, None, None, None),
    ('comercial', 'E026RAM', ('CODRAM',), None, None, None, None, None),
    ('comercial', 'E069GRE', ('CODGRE',), None, None, None, None, None),
    ('comercial', 'E073TRA', ('CODTRA',), None, None, None, None, None),
    ('comercial', 'E085CLI', ('CODCLI',), None, None, None, None, None),
    ('comercial', 'E090REP', ('CODREP',), None, None, None, None, None),
    ('comercial', 'E095FOR', ('CODFOR',), None, None, None, None, None),
    ('comercial', 'USU_T017RVR', ('USU_CODRVR',), 'USU_DATGER', None, None, None, None),
    ('comercial', 'USU_T101CRI', ('USU_CODCRI',), None, None, None, None, None),
    ('comercial', 'USU_T101MET', ('USU_CODEMP', 'USU_MESANO', 'USU_CODTIP', 'USU_SEQREG'), 'USU_DATGER', None, None, 'USU_CODEMP', None),
    ('comercial', 'USU_T101TIP', ('USU_CODTIP',), None, None, None, None, None),
    ('comercial', 'USU_TPCAMNC', ('USU_CODMNC',), None, None, None, None, None),
    ('comercial', 'USU_TPCAPFC', ('USU_CODPFC',), None, None, None, None, None),
    ('comercial', 'USU_TPCRCDG', ('USU_CODEMP', 'USU_CODGRA'), None, None, None, None, None),
    ('comercial', 'USU_TPCRCPC', ('USU_CODCLI',), None, None, None, None, None),
    ('comercial', 'R999USU', ('CODUSU',), None, None, None, None, None),
    ('laudos_rma', 'USU_TLAUITE', ('USU_CODEMP', 'USU_CODFIL', 'USU_CODLAU', 'USU_SEQIPC', 'USU_SEQUNI'), 'USU_DATALT', None, None, 'USU_CODEMP', None),
    ('laudos_rma', 'USU_TLAUGER', ('USU_CODEMP', 'USU_CODFIL', 'USU_CODLAU'), 'USU_DATALT', None, None, 'USU_CODEMP', None),
    ('laudos_rma', 'USU_TLAUDEF', ('USU_CODEMP', 'USU_CODPRO', 'USU_CODDER', 'USU_CODDEF'), 'USU_DATALT', None, None, 'USU_CODEMP', None),
    ('laudos_rma', 'USU_TLAUCOR', ('USU_CODCOR',), None, None, None, None, None),
    ('laudos_rma', 'USU_TLAUPRB', ('USU_CODPRB',), None, None, None, None, None),
    ('laudos_rma', 'USU_TLAUSIT', ('USU_CODSIT',), None, None, None, None, None),
    ('laudos_rma', 'USU_TLAUTIP', ('USU_CODTIP',), None, None, None, None, None),
    ('laudos_rma', 'R910USU', ('CODENT',), 'DATALT', None, None, None, None),
    ('laudos_rma', 'USU_VZRASLAU', None, None, None, None, 'EMPNFV', None),
    ('producao', 'E018MTV', ('CODEMP', 'CODMTV'), None, None, None, 'CODEMP', None),
    ('producao', 'E044CCU', ('CODEMP', 'CODCCU'), None, None, None, 'CODEMP', None),
    ('producao', 'E047NTG', ('CODEMP', 'CODNTG'), None, None, None, 'CODEMP', None),
    ('producao', 'E093ETG', ('CODEMP', 'CODETG'), None, None, None, 'CODEMP', None),
    ('producao', 'E210MVP', ('CODEMP', 'CODPRO', 'CODDER', 'CODDEP', 'DATMOV', 'SEQMOV'), 'DATMOV', None, None, 'CODEMP', None),
    ('producao', 'E621MTC', ('NUMMTC',), 'DATATU', None, None, 'CODEMP', None),
    ('producao', 'E626ORC', ('NUMMTC', 'CODEMP', 'CODCCU', 'CODNTG'), None, None, None, 'CODEMP', None),
    ('producao', 'E626TAX', ('NUMMTC', 'CODEMP', 'CODCCU', 'CODGNG'), None, None, None, 'CODEMP', None),
    ('producao', 'E630SPE', ('NUMMTC', 'CODPRO', 'CODDER', 'CODETG', 'CODCCU', 'CODORI', 'NUMORP', 'TIPMPE'), None, None, None, 'CODEMP', None),
    ('producao', 'E720OPR', ('CODEMP', 'CODOPR'), 'DATALT', None, None, 'CODEMP', None),
    ('producao', 'E725CRE', ('CODEMP', 'CODCRE'), 'DATALT', None, None, 'CODEMP', None),
    ('producao', 'E900COP', ('CODEMP', 'CODORI', 'NUMORP'), None, None, None, 'CODEMP', None),
    ('producao', 'E900EOQ', ('CODEMP', 'CODORI', 'NUMORP', 'CODETG', 'SEQEOQ'), 'DATREA', None, '1900-12-31', 'CODEMP', None),
    ('producao', 'E900OOP', ('CODEMP', 'CODORI', 'NUMORP', 'CODETG', 'SFXETR', 'SEQROT', 'SFXSEQ'), None, None, None, 'CODEMP', None),
    ('producao', 'E900QDO', ('CODEMP', 'CODORI', 'NUMORP', 'CODPRO', 'CODDER'), None, None, None, 'CODEMP', None),
    ('producao', 'E930MPR', ('CODEMP', 'CODFIL', 'CODETG', 'CODCRE', 'IDEBEM', 'DATMPR', 'CODMTV', 'SEQMPR'), 'DATMPR', None, None, 'CODEMP', None),
    ('opex', 'R910USU', ('CODENT',), 'DATALT', None, None, None, None),
    ('opex', 'E044CCU', ('CODEMP', 'CODCCU'), None, None, None, 'CODEMP', None),
    ('opex', 'USU_T650ORC', ('USU_CODEMP', 'USU_MESANO', 'USU_CTADRE', 'USU_CODCCU'), 'USU_DATALT', None, None, 'USU_CODEMP', None),
    ('opex', 'USU_T650CUS', ('USU_CODEMP', 'USU_MESANO', 'USU_CODMPC', 'USU_CTADRE', 'USU_CTAEMP', 'USU_CODCCU'), 'USU_DATALT', None, None, 'USU_CODEMP', None),
    ('opex', 'E043PCM', ('CODMPC', 'CTARED'), 'DATALT', 'DATGER', None, None, None),
    ('estoque', 'E420IPO', ('CODEMP', 'CODFIL', 'NUMOCP', 'SEQIPO'), None, None, None, 'CODEMP', None),
    ('estoque', 'E420OCP', ('CODEMP', 'CODFIL', 'NUMOCP'), None, None, None, 'CODEMP', None),
    ('estoque', 'E700CMM', ('CODEMP', 'CODMOD', 'CODETG', 'SEQMOD'), 'DATALT', None, None, 'CODEMP', None),
    ('expedicao', 'R900GRP', ('GRPID', 'MEMID'), None, None, None, None, None),
    ('expedicao', 'USU_V120EST', None, None, None, None, 'CODEMP', 'CODFIL'),
    ('rastreabilidade', 'USU_T140QRC', ('USU_CODEMP', 'USU_CODFIL', 'USU_CODSNF', 'USU_NUMNFV', 'USU_SEQIPV', 'USU_CODBAR'), 'USU_DATGER', None, None, 'USU_CODEMP', 'USU_CODFIL'),
]


def bronze_catalog() -> Catalog:
    cat = Catalog()
    for area, name, keys, audit, fallback, sentinel, company, branch in ENTRIES:
        cat.add(TableSpec(name=name, keys=keys, audit_col=audit, fallback_col=fallback, sentinel=sentinel,
                          company_col=company, company_values=AREA_COMPANIES.get(area, DEFAULT_COMPANIES),
                          branch_col=branch, branch_values=BRANCHES, owner=area,
                          kind="dimension" if audit is None else "fact"))
    multi = {}
    for s in cat.specs.values():
        multi.setdefault(s.name, []).append(s.owner)
    cat.multi_writer = {k: tuple(v) for k, v in multi.items() if len(v) > 1}
    return cat


# Generation (creation) dates never change after a row is written, so they are
# safe storage partitions: a merge or sweep rewrites only the months it touches.
IMMUTABLE_DATE_COLUMNS = ("DATGER", "USU_DATGER")


def default_partition_cols() -> dict[str, str]:
    """Table -> immutable generation-date column, for tables that have one."""
    from ..plans.bronze_schemas import BRONZE_SCHEMAS
    out = {}
    for name, ddl in BRONZE_SCHEMAS.items():
        cols = {c.split()[0] for c in ddl.split(", ")}
        for c in IMMUTABLE_DATE_COLUMNS:
            if c in cols:
                out[name] = c
                break
    return out
