"""Bronze table schemas: the columns the silver products read, with their types.

Physical types of the source dictionary are not available; money and
quantities are DECIMAL(18,4), codes are text unless used as numbers, every
date is a timestamp (the source DATE type carries a time of day).
"""

BRONZE_SCHEMAS: dict[str, str] = {
    "E001TNS": (
        "CODEMP bigint, CODTNS string, COMNAT string, CPRTCF string, VENFAT string"
    ),
    "E012FAM": (
        "CODEMP bigint, CODFAM string, DESFAM string"
    ),
    "E013AGP": (
        "CODAGP string, CODEMP bigint, DESAGP string, TIPAGP string"
    ),
    "E018MTV": (
        "ABRMTV string, CODEMP bigint, CODMTV string, DESMTV string, USU_CLAMTV bigint, "
        "USU_TIPMTV bigint"
    ),
    "E022CLF": (
        "CLAFIS string, CODCES string, CODCLF string"
    ),
    "E026RAM": (
        "CODRAM string, DESRAM string"
    ),
    "E028CPG": (
        "ABRCPG string, CODCPG string, CODEMP bigint, DATATU timestamp_ntz, DATGER timestamp_ntz, "
        "DESCPG string, PRZMED bigint, QTDPAR decimal(18,4), SITCPG string"
    ),
    "E043PCM": (
        "CODMPC string, CTARED string, DATALT timestamp_ntz, DATGER timestamp_ntz, DESCTA string"
    ),
    "E044CCU": (
        "ABRCCU string, CCUPAI string, CODCCU string, CODEMP bigint, DESCCU string, TIPCCU bigint, "
        "USU_CODCOR string, USU_CODRES string"
    ),
    "E047NTG": (
        "CODEMP bigint, CODNTG string, DESNTG string"
    ),
    "E066FPG": (
        "CODEMP bigint, CODFPG string, DESFPG string"
    ),
    "E069GRE": (
        "CLIBAS bigint, CODGRE string, NOMGRE string"
    ),
    "E073TRA": (
        "APETRA string, CODTRA string, NOMTRA string"
    ),
    "E075DER": (
        "ALTDER decimal(18,4), CODAGT string, CODDER string, CODEMP bigint, CODGTN string, "
        "CODPRO string, COMDER decimal(18,4), CURABC string, LARDER decimal(18,4), "
        "PESBRU decimal(18,4), PESLIQ decimal(18,4), SITDER string"
    ),
    "E075PRO": (
        "CODAGE string, CODCLF string, CODEMP bigint, CODFAM string, CODORI string, CODPRO string, "
        "DEPPAD string, DESPRO string, ORIMER string, PERIPI decimal(18,4), SITPRO string, "
        "TIPPRO string, UNIMED string, USU_INDFDL string"
    ),
    "E085CLI": (
        "APECLI string, BAICLI string, CEPCLI string, CGCCPF string, CIDCLI string, CLICON string, "
        "CODCLI bigint, CODGRE string, CODRAM string, CPLEND string, DATATU timestamp_ntz, "
        "DATCAD timestamp_ntz, ENDCLI string, FONCL2 string, FONCLI string, INTNET string, "
        "NENCLI string, NOMCLI string, SIGUFS string, SITCLI string, TIPCLI string, "
        "USU_CODRVR bigint"
    ),
    "E085HCL": (
        "CODCLI bigint, CODCPG string, CODEMP bigint, CODFIL bigint, CODFPG string, CODREP bigint, "
        "CODTRA string, CONFIN string, DATLIM timestamp_ntz, LIMAPR string, USU_CODMNC string, "
        "USU_CODPFC string, VLRLIM decimal(18,4)"
    ),
    "E090REP": (
        "APEREP string, CGCCPF string, CIDREP string, CODREP bigint, DATCAD timestamp_ntz, "
        "FONREP string, INTNET string, NOMREP string, SIGUFS string, SITWMW string, TIPREP string, "
        "USU_CODRAM string, USU_CODRVR bigint, USU_TIPREP string"
    ),
    "E093ETG": (
        "ABRETG string, CODCCU string, CODEMP bigint, CODETG string, DESETG string"
    ),
    "E095FOR": (
        "CIDFOR string, CODCLI bigint, CODFOR string, FONFO2 string, FONFO3 string, FONFOR string, "
        "INTNET string, NOMFOR string, SIGUFS string, TIPFOR string"
    ),
    "E120IPD": (
        "CODDEP string, CODDER string, CODEMP bigint, CODFIL bigint, CODPRO string, CODREP bigint, "
        "DATGER timestamp_ntz, NUMPED bigint, PEROFE decimal(18,4), PREUNI decimal(18,4), "
        "QTDABE decimal(18,4), SEQIPD bigint, TNSPRO string, VLRICM decimal(18,4), "
        "VLRICS decimal(18,4), VLRIPI decimal(18,4), VLRLIQ decimal(18,4), VLROFE decimal(18,4), "
        "VLROUT decimal(18,4), VSTFCP decimal(18,4)"
    ),
    "E120PED": (
        "CODCLI bigint, CODCPG string, CODEMP bigint, CODFIL bigint, CODFPG string, CODTRA string, "
        "DATGER timestamp_ntz, DATPRV timestamp_ntz, NUMPED bigint, SITPED string, "
        "USU_CLIBAS bigint, USU_CODRVRCLI string, USU_CODRVRREP string"
    ),
    "E140IDE": (
        "CODEMP bigint, CODFIL bigint, CODSNF string, NUMNFV bigint, SITDOE bigint"
    ),
    "E140IPV": (
        "CODDEP string, CODDER string, CODEMP bigint, CODFIL bigint, CODPRO string, CODSNF string, "
        "DATGER timestamp_ntz, NUMNFV bigint, NUMPED bigint, PEROFE decimal(18,4), "
        "PREUNI decimal(18,4), QTDFAT decimal(18,4), SEQIPD bigint, SEQIPV bigint, TNSPRO string, "
        "VLRICM decimal(18,4), VLRICS decimal(18,4), VLRIPI decimal(18,4), VLRLIQ decimal(18,4), "
        "VLROFE decimal(18,4), VLROUT decimal(18,4)"
    ),
    "E140ISV": (
        "CODEMP bigint, CODFIL bigint, CODSER string, CODSNF string, DATGER timestamp_ntz, "
        "NUMNFV bigint, NUMPED bigint, PREUNI decimal(18,4), QTDFAT decimal(18,4), SEQIPV bigint, "
        "SEQISV bigint, TNSSER string, VLRICM decimal(18,4), VLRICS decimal(18,4), "
        "VLRIPI decimal(18,4), VLRLIQ decimal(18,4), VLROUT decimal(18,4)"
    ),
    "E140NFV": (
        "CODCLI bigint, CODCPG string, CODEMP bigint, CODFIL bigint, CODFPG string, CODREP bigint, "
        "CODSNF string, CODTRA string, DATEMI timestamp_ntz, DATGER timestamp_ntz, NUMNFV bigint, "
        "SITNFV string, TIPNFS bigint, TNSPRO string, USU_CLIBAS bigint, USU_CODRAS string, "
        "USU_CODRVRCLI string, USU_CODRVRREP string, USU_ENTCOR timestamp_ntz"
    ),
    "E140PVD": (
        "CODEMP bigint, CODFIL bigint, CODSNF string, NUMNFV bigint, SEQIPV bigint, "
        "VSTFCP decimal(18,4)"
    ),
    "E210MVP": (
        "CODDEP string, CODDER string, CODEMP bigint, CODETG string, CODPRO string, CODTNS string, "
        "DATMOV timestamp_ntz, ESTEOS string, NUMDOC bigint, ORIORP string, QTDMOV decimal(18,4), "
        "SEQMOV bigint, VLRMOV decimal(18,4)"
    ),
    "E420IPO": (
        "CODEMP bigint, CODFIL bigint, NUMOCP bigint, SEQIPO bigint"
    ),
    "E420OCP": (
        "CODEMP bigint, CODFIL bigint, NUMOCP bigint"
    ),
    "E440IPC": (
        "CODDEP string, CODDER string, CODEMP bigint, CODFIL bigint, CODFOR string, CODPRO string, "
        "CODSNF string, DATGER timestamp_ntz, ICMVFC decimal(18,4), NUMNFC bigint, NUMNFV bigint, "
        "NUMPED bigint, PREUNI decimal(18,4), QTDREC decimal(18,4), SEQIPC bigint, SNFNFV string, "
        "TNSPRO string, VECIPI decimal(18,4), VLRICM decimal(18,4), VLRICS decimal(18,4), "
        "VLRLIQ decimal(18,4), VLROUT decimal(18,4)"
    ),
    "E440NFC": (
        "CODCPG string, CODEMP bigint, CODFIL bigint, CODFOR string, CODFPG string, CODSNF string, "
        "CODTRA string, DATENT timestamp_ntz, DATGER timestamp_ntz, NUMNFC bigint, SITNFC string, "
        "TIPNFE string, USU_DATCON timestamp_ntz, USU_MOTDEV string, VSTFCP decimal(18,4)"
    ),
    "E621MTC": (
        "CODEMP bigint, CODMTC string, DATATU timestamp_ntz, DATFIM timestamp_ntz, "
        "DATINI timestamp_ntz, DESMTC string, NUMMTC bigint, TIPMTC string"
    ),
    "E626ORC": (
        "CODCCU string, CODEMP bigint, CODNTG string, NUMMTC bigint, VALVIS decimal(18,4)"
    ),
    "E626TAX": (
        "CODCCU string, CODEMP bigint, CODGNG string, NUMMTC bigint, TAXCUS decimal(18,4)"
    ),
    "E630SPE": (
        "CODCCU string, CODDER string, CODEMP bigint, CODETG string, CODORI string, CODPRO string, "
        "NUMMTC bigint, NUMORP bigint, SDOATU decimal(18,4), TIPMPE string"
    ),
    "E700CMM": (
        "CODEMP bigint, CODETG string, CODMOD string, DATALT timestamp_ntz, SEQMOD bigint"
    ),
    "E720OPR": (
        "ABROPR string, CODCCU string, CODCRE string, CODEMP bigint, CODETG string, CODOPR string, "
        "DATALT timestamp_ntz, DESOPR string, MOVORP string, UNICRE string"
    ),
    "E725CRE": (
        "ABRCRE string, CODCCU string, CODCRE string, CODEMP bigint, DATALT timestamp_ntz, "
        "DESCRE string"
    ),
    "E900COP": (
        "CODEMP bigint, CODORI string, CODPRO string, DTRFIM timestamp_ntz, DTRINI timestamp_ntz, "
        "NUMORP bigint, SITORP string"
    ),
    "E900EOQ": (
        "CODCRE string, CODDER string, CODEMP bigint, CODETG string, CODOPR string, CODORI string, "
        "CODPRO string, DATREA timestamp_ntz, HORREA bigint, NUMORP bigint, QTDRE1 decimal(18,4), "
        "SEQEOQ bigint, SEQROT bigint, TMPBRU decimal(18,4)"
    ),
    "E900OOP": (
        "CODEMP bigint, CODETG string, CODOPR string, CODORI string, NUMORP bigint, SEQROT bigint, "
        "SFXETR string, SFXSEQ string, TMPPRP decimal(18,4), UNICRE string"
    ),
    "E900QDO": (
        "CODDER string, CODEMP bigint, CODORI string, CODPRO string, NUMORP bigint, "
        "QTDPRV decimal(18,4), QTDRFG decimal(18,4)"
    ),
    "E930MPR": (
        "CODCRE string, CODEMP bigint, CODETG string, CODFIL bigint, CODMTV string, "
        "DATMPR timestamp_ntz, HORFIM bigint, HORINI bigint, IDEBEM string, QTDHOR decimal(18,4), "
        "SEQMPR bigint"
    ),
    "R900GRP": (
        "GRPID bigint, MEMID bigint"
    ),
    "R910USU": (
        "CODENT string, DATALT timestamp_ntz, NOMCOM string"
    ),
    "R999USU": (
        "CODUSU string, NOMUSU string"
    ),
    "USU_T017RVR": (
        "USU_CODRVR bigint, USU_DATGER timestamp_ntz, USU_NOMRVR string, USU_USUASS string, "
        "USU_USUCOR string"
    ),
    "USU_T101CRI": (
        "USU_CODCRI string, USU_DESCRI string, USU_DIRCRI bigint, USU_UNICRI bigint"
    ),
    "USU_T101MET": (
        "USU_CODAGP string, USU_CODCRI string, USU_CODEMP bigint, USU_CODPRO string, "
        "USU_CODREP bigint, USU_CODRVR bigint, USU_CODTIP string, USU_DATGER timestamp_ntz, "
        "USU_MESANO timestamp_ntz, USU_NOMUSU string, USU_PESCRI decimal(18,4), USU_SEQREG bigint, "
        "USU_VLRMET decimal(18,4)"
    ),
    "USU_T101TIP": (
        "USU_CODTIP string, USU_DESTIP string"
    ),
    "USU_T140QRC": (
        "USU_CODBAR string, USU_CODEMP bigint, USU_CODFIL bigint, USU_CODSNF string, "
        "USU_DATGER timestamp_ntz, USU_NUMNFV bigint, USU_SEQIPV bigint"
    ),
    "USU_T650CUS": (
        "USU_CODCCU string, USU_CODEMP bigint, USU_CODMPC string, USU_CTADRE string, "
        "USU_CTAEMP string, USU_DATALT timestamp_ntz, USU_MESANO timestamp_ntz, "
        "USU_SALMES decimal(18,4)"
    ),
    "USU_T650ORC": (
        "USU_CODCCU string, USU_CODEMP bigint, USU_CODMPC string, USU_CTADRE string, "
        "USU_DATALT timestamp_ntz, USU_MESANO timestamp_ntz, USU_ORCMES decimal(18,4)"
    ),
    "USU_TLAUCOR": (
        "USU_CODCOR string, USU_DESCOR string"
    ),
    "USU_TLAUDEF": (
        "USU_CODDEF string, USU_CODDER string, USU_CODEMP bigint, USU_CODPRO string, "
        "USU_DATALT timestamp_ntz, USU_DESDEF string"
    ),
    "USU_TLAUGER": (
        "USU_CODEMP bigint, USU_CODFIL bigint, USU_CODLAU string, USU_CODSIT string, "
        "USU_DATALT timestamp_ntz, USU_DATSEP timestamp_ntz, USU_NUMNFV bigint, USU_TIPLAU string, "
        "USU_USUFIN string"
    ),
    "USU_TLAUITE": (
        "USU_CODCOR string, USU_CODDEF string, USU_CODDER string, USU_CODEMP bigint, "
        "USU_CODFIL bigint, USU_CODFOR string, USU_CODLAU string, USU_CODPRB string, "
        "USU_CODPRO string, USU_DATALT timestamp_ntz, USU_NUMNFC bigint, USU_OBSCLI string, "
        "USU_PECFAL string, USU_PECTRO string, USU_SEQIPC bigint, USU_SEQUNI bigint, "
        "USU_SERMAC string, USU_TMPUTI decimal(18,4), USU_USUTEC string"
    ),
    "USU_TLAUPRB": (
        "USU_CODPRB string, USU_DESPRB string"
    ),
    "USU_TLAUSIT": (
        "USU_CODSIT string, USU_DESSIT string"
    ),
    "USU_TLAUTIP": (
        "USU_CODTIP string, USU_DESTIP string"
    ),
    "USU_TPCAMNC": (
        "USU_CODMNC string, USU_DSCMNC string"
    ),
    "USU_TPCAPFC": (
        "USU_CODPFC string, USU_DSCPFC string"
    ),
    "USU_TPCRCDG": (
        "USU_CODEMP bigint, USU_CODGRA string, USU_DESGRA string"
    ),
    "USU_TPCRCPC": (
        "USU_CODCLI bigint, USU_CODGRA string"
    ),
    "USU_V120EST": (
        "CODEMP bigint, CODFIL bigint"
    ),
    "USU_VZRASLAU": (
        "CODFOR string, DATEMINFC timestamp_ntz, DATEMIOCP timestamp_ntz, DATENTNFC timestamp_ntz, "
        "EMPNFV bigint, FILNFV bigint, NOMFOR string, NUMNFC bigint, NUMOCP bigint, "
        "USU_CODBAR string, USU_DATEMB timestamp_ntz, USU_NUMINV bigint"
    ),
}
