"""Column expressions that keep the source database's semantics.

The silver layer of the source system was written in a dialect where

* an empty string IS NULL, and trimming blanks yields NULL            (T1, T3)
* ``a || NULL = a``                                                    (T2)
* ascending order puts NULLs last, descending puts them first          (T4)
* division by zero is guarded with NULLIF                              (T10)
* tolerant conversions turn bad text into NULL                         (T12)

Spark's defaults differ on every one of these, so every product and operator
goes through the helpers below.  All helpers return ``Column`` objects: they are
evaluated JVM-side inside whole-stage code generation; nothing here is a UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# ---------------------------------------------------------------------------
# Fixed values (must equal the source system's for identical results)
# ---------------------------------------------------------------------------
# Sentinel written by the source system for "no date".
SENTINEL_DATE = "1900-12-31"
# Blank sentinel used by the source system for "empty" text columns.
BLANK = " "
# Serial numbers that mean "no serial" (repeat-entry class 2).
INVALID_SERIALS = (" ", "S/N", "SN")
# Repeat-entry threshold in days and the SLA limit in days.
REPEAT_DAYS = 180
SLA_DAYS = 10
# Origin codes counted as imported goods.
IMPORTED_ORIGINS = ("1", "6", "3", "8", "7")
# Carriers reported by name in the delivery column; others are NULL.
DELIVERY_CARRIERS = ("TEX COURIER LTDA. EM RECUPERACAO JUDICIAL", "CORREIO / SEDEX")
# State -> macro region.
MACRO_REGION = {
    "RS": "Sul", "SC": "Sul", "PR": "Sul",
    "SP": "Sudeste", "RJ": "Sudeste", "ES": "Sudeste", "MG": "Sudeste",
    "RR": "Norte", "RO": "Norte", "AM": "Norte", "AC": "Norte",
    "AP": "Norte", "TO": "Norte", "PA": "Norte",
    "CE": "Nordeste", "PI": "Nordeste", "SE": "Nordeste", "RN": "Nordeste",
    "PB": "Nordeste", "PE": "Nordeste", "BA": "Nordeste", "MA": "Nordeste",
    "AL": "Nordeste",
    "DF": "Centro-Oeste", "MS": "Centro-Oeste", "MT": "Centro-Oeste", "GO": "Centro-Oeste",
}
# SLA labels (open late, open on time, finished on time, finished late).
SLA_LABELS = ("Em Aberto Atrasado", "Em Aberto no Prazo", "Finalizado no Prazo",
              "Finalizado em Atraso")
# Delivery buckets, most specific first, and the no-date label.
DELIVERY_LABELS = ("Maior que 30 Dias", "Entre 21 e 30 Dias", "Entre 11 e 20 Dias",
                   "Entre 0 e 10 Dias")
NO_DATE = "Sem Data"
# Transport type labels: no outgoing note, postal service, pick-up, carriers.
TRANSPORT_LABELS = ("Sem NFSaída", "Correios", "Retirada", "Transportadoras")
TRANSPORT_POSTAL = "CORREIO / SEDEX"
TRANSPORT_PICKUP = "RETIRA"
# Minutes per unit for time scaling (D days, H hours, M minutes, S seconds).
UNIT_MINUTES = {"D": 1440, "H": 60, "M": 1}


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------
# Text (T1-T3, SCA-01..08)
# ---------------------------------------------------------------------------
def blank_to_null(c: ColumnOrName) -> Column:
    """Trimmed text, NULL when empty (the source dialect's '' IS NULL)."""
    t = F.trim(_c(c))
    return F.when(t == "", F.lit(None).cast("string")).otherwise(t)


def empty_to_null(c: ColumnOrName) -> Column:
    """'' -> NULL without trimming (ingest normalisation)."""
    x = _c(c)
    return F.when(x == "", F.lit(None).cast("string")).otherwise(x)


def oconcat(*cols: ColumnOrName) -> Column:
    """NULL-ignoring concatenation: ``a || NULL = a`` (Spark's concat gives NULL)."""
    return F.concat_ws("", *[_c(c).cast("string") for c in cols])


def trim_upper(c: ColumnOrName) -> Column:
    """TRIM(UPPER(c)); an all-blank value (the ' ' sentinel) gives NULL (T3)."""
    return blank_to_null(F.upper(_c(c)))


def trim_lower(c: ColumnOrName) -> Column:
    """TRIM(LOWER(c)); an all-blank value gives NULL (T3)."""
    return blank_to_null(F.lower(_c(c)))


def digits_only(c: ColumnOrName) -> Column:
    """Keep digits only; an all-non-digit value becomes NULL like the dialect's ''."""
    return empty_to_null(F.regexp_replace(_c(c).cast("string"), "[^0-9]", ""))


def lpad_num(c: ColumnOrName, width: int, pad: str = "0") -> Column:
    """LPAD of the text form; truncates when longer (T9)."""
    return F.lpad(_c(c).cast("string"), width, pad)


def tax_id(c: ColumnOrName, person_type: ColumnOrName) -> Column:
    """Tax id padded by person type: individual 'F' -> 11 digits, company 'J' -> 14."""
    p = _c(person_type)
    return (F.when(p == "F", lpad_num(c, 11))
            .when(p == "J", lpad_num(c, 14))
            .otherwise(_c(c).cast("string")))


def fm00(c: ColumnOrName) -> Column:
    """TO_CHAR(n, 'FM00'): two digits, '###' on overflow."""
    s = _c(c).cast("string")
    return F.when(F.length(s) > 2, F.lit("###")).otherwise(F.lpad(s, 2, "0"))


def dots_to_spaces(c: ColumnOrName) -> Column:
    return F.replace(_c(c), F.lit("."), F.lit(" "))


def full_address(street: ColumnOrName, number: ColumnOrName, complement: ColumnOrName,
                 faithful: bool = True) -> Column:
    """Street + ', ' + number [+ ' (complement)'].

    ``faithful=True`` reproduces the source: its test ``TRIM(c) <> ''`` compares
    with NULL, so the complement branch is never taken (T1).
    """
    base = oconcat(street, F.lit(", "), number)
    if faithful:
        return base
    comp = blank_to_null(complement)
    return F.when(comp.isNotNull(), oconcat(base, F.lit(" ("), comp, F.lit(")"))).otherwise(base)


# ---------------------------------------------------------------------------
# Ordering (T4)
# ---------------------------------------------------------------------------
def asc(c: ColumnOrName) -> Column:
    return _c(c).asc_nulls_last()


def desc(c: ColumnOrName) -> Column:
    return _c(c).desc_nulls_first()


# ---------------------------------------------------------------------------
# Numbers (T10, T12, SCA-11, SCA-13, SCA-19, SCA-28)
# ---------------------------------------------------------------------------
def safe_div(a: ColumnOrName, b: ColumnOrName) -> Column:
    """a / NULLIF(b, 0)."""
    return _c(a) / F.nullif(_c(b), F.lit(0))


# A plain decimal number: no type suffix, no NaN or infinity, no hexadecimal.
_NUMBER = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)$"
DOUBLE_SCALE = 10


def money(df: DataFrame, c: str, scale: int = DOUBLE_SCALE) -> Column:
    """Exactly summable view of a numeric column: decimals and integers as they
    are, DOUBLE and FLOAT as DECIMAL with ``scale`` decimals (never sum doubles)."""
    if df.schema[c].dataType.typeName() in ("double", "float"):
        return F.col(c).cast(f"decimal({18 + scale},{scale})")
    return F.col(c)


def locale_decimal(c: ColumnOrName) -> Column:
    """Decimal comma text ('12,5') -> 12.5; bad text -> NULL (SCA-28)."""
    x = F.replace(F.trim(_c(c).cast("string")), F.lit(","), F.lit("."))
    return F.when(x.rlike(_NUMBER), x.try_cast("double"))


def int_text(c: ColumnOrName) -> Column:
    """Number -> clean integer text, NULL -> '', other text trimmed (SCA-19)."""
    x = F.trim(_c(c).cast("string"))
    whole = F.when(x.rlike(_NUMBER), x.try_cast("decimal(38,10)").cast("decimal(38,10)"))
    return (F.when(x.isNull(), F.lit(""))
            .otherwise(F.coalesce(F.regexp_replace(whole.cast("string"), "[.].*$", ""), x)))


def signed(value: ColumnOrName, flag: ColumnOrName, positive: str) -> Column:
    """value when flag == positive else -value (AGG-04)."""
    return F.when(_c(flag) == positive, _c(value)).otherwise(-_c(value))


def scale_to_minutes(value: ColumnOrName, unit: ColumnOrName) -> Column:
    """D x1440, H x60, M x1, S /60, unknown unit unchanged (AGG-11)."""
    v, u = _c(value), _c(unit)
    e = F.when(u == "S", v.cast("double") / 60)
    for k, m in UNIT_MINUTES.items():
        e = e.when(u == k, v * m)
    return e.otherwise(v)


# ---------------------------------------------------------------------------
# Dates (T8, SCA-14..18, SCA-22..26)
# ---------------------------------------------------------------------------
def day(c: ColumnOrName) -> Column:
    """TRUNC(date) -> DATE."""
    return F.to_date(_c(c))


def month_start(c: ColumnOrName) -> Column:
    """TRUNC(date, 'MM') -> DATE."""
    return F.trunc(_c(c), "MM")


def month_index(c: ColumnOrName) -> Column:
    """Gap-aware month ordinal (year*12 + month - 1) for RANGE windows."""
    x = _c(c)
    return F.year(x) * 12 + F.month(x) - 1


def month_key(c: ColumnOrName) -> Column:
    """Month without zero padding + '|' + year (T14)."""
    x = _c(c)
    return F.concat_ws("|", F.month(x).cast("string"), F.year(x).cast("string"))


def quarter_label(c: ColumnOrName) -> Column:
    """'Q1'..'Q4'; a NULL date falls to the ELSE branch 'Q4' (SCA-17)."""
    m = F.month(_c(c))
    return (F.when(m.between(1, 3), "Q1").when(m.between(4, 6), "Q2")
            .when(m.between(7, 9), "Q3").otherwise("Q4"))


def same_month(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Month-only equality ignoring the year (SCA-18); NULL -> false branch."""
    return F.coalesce(F.month(_c(a)) == F.month(_c(b)), F.lit(False))


def lookback_start(as_of, days: int) -> Column:
    """as_of - N days, keeping the time of day (T8)."""
    return F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAYS")


def _time_of_day(x: Column) -> Column:
    """Time since midnight as a day-time interval, computed on local timestamps
    only (no session time zone: a DST gap at midnight cannot shift it)."""
    t = x.cast("timestamp_ntz")
    return t - F.to_date(t).cast("timestamp_ntz")


def full_days(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Whole days from b to a, floored (pandas ``(a - b).dt.days``), TZ-free."""
    x, y = _c(a), _c(b)
    return F.datediff(F.to_date(x), F.to_date(y)) - F.when(_time_of_day(x) < _time_of_day(y), 1).otherwise(0)


def is_sentinel_or_null(c: ColumnOrName) -> Column:
    x = _c(c)
    return x.isNull() | (F.to_date(x) == F.lit(SENTINEL_DATE).cast("date"))


def sla_status(entry: ColumnOrName, finish: ColumnOrName, as_of) -> Column:
    """SLA label from an explicit as-of date (SCA-23)."""
    open_days = full_days(F.lit(as_of).cast("timestamp_ntz"), entry)
    done_days = full_days(finish, entry)
    f = _c(finish)
    late_open, ok_open, ok_done, late_done = SLA_LABELS
    return (F.when(f.isNull() & (open_days > SLA_DAYS), late_open)
            .when(f.isNull() & (open_days <= SLA_DAYS), ok_open)
            .when(f.isNotNull() & (done_days <= SLA_DAYS), ok_done)
            .when(f.isNotNull() & (done_days > SLA_DAYS), late_done))


def sla_days(entry: ColumnOrName, finish: ColumnOrName, as_of) -> Column:
    return F.when(_c(finish).isNull(), full_days(F.lit(as_of).cast("timestamp_ntz"), entry)) \
        .otherwise(full_days(finish, entry))


def delivery_days(delivered: ColumnOrName, entry: ColumnOrName) -> Column:
    d = full_days(delivered, entry)
    return F.when(_c(delivered).isNotNull() & (d >= 0), d)


def delivery_bucket(delivered: ColumnOrName, entry: ColumnOrName) -> Column:
    """Delivery class; zero days falls to the no-date label like the source (SCA-25)."""
    d = full_days(delivered, entry)
    valid = _c(delivered).isNotNull() & (d >= 0)
    gt30, gt20, gt10, gt0 = DELIVERY_LABELS
    return (F.when(~valid, NO_DATE).when(d > 30, gt30).when(d > 20, gt20)
            .when(d > 10, gt10).when(d > 0, gt0).otherwise(NO_DATE))


def finish_year_text(finish: ColumnOrName) -> Column:
    return F.when(is_sentinel_or_null(finish), F.lit(NO_DATE)).otherwise(
        F.year(_c(finish)).cast("string"))


def invalid_serial(serial: ColumnOrName) -> Column:
    s = _c(serial)
    return s.isNull() | s.isin(*INVALID_SERIALS)


def repeat_class(serial: ColumnOrName, day_: ColumnOrName, prev_day: ColumnOrName,
                 limit_days: int = REPEAT_DAYS) -> Column:
    """2 invalid serial, 1 previous entry within the limit, 0 otherwise (SCA-24)."""
    gap = full_days(day_, prev_day)
    return (F.when(invalid_serial(serial), 2)
            .when(_c(prev_day).isNull() | (gap > limit_days), 0)
            .otherwise(1))


def repeat_days(serial: ColumnOrName, day_: ColumnOrName, prev_day: ColumnOrName) -> Column:
    return F.when(invalid_serial(serial) | _c(prev_day).isNull(), 0).otherwise(
        full_days(day_, prev_day))


def transport_type(carrier: ColumnOrName) -> Column:
    c = _c(carrier)
    none_, postal, pickup, other = TRANSPORT_LABELS
    return (F.when(c.isNull(), none_).when(c == TRANSPORT_POSTAL, postal)
            .when(c == TRANSPORT_PICKUP, pickup).otherwise(other))


def delivery_carrier(carrier: ColumnOrName) -> Column:
    c = _c(carrier)
    return F.when(c.isin(*DELIVERY_CARRIERS), c)


# ---------------------------------------------------------------------------
# Look-ups and flags (SCA-12, SCA-20, SCA-21, SCA-27, SCA-29)
# ---------------------------------------------------------------------------
def map_lookup(c: ColumnOrName, mapping: Mapping[str, str]) -> Column:
    """Literal map look-up, unmapped -> NULL (JVM-side, no join)."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.element_at(m, _c(c).cast("string")) if mapping else F.lit(None)


def macro_region(state: ColumnOrName) -> Column:
    return F.try_element_at(
        F.create_map(*[F.lit(x) for kv in MACRO_REGION.items() for x in kv]), _c(state))


def member_flag(c: ColumnOrName, members: Iterable, yes: str, no: str) -> Column:
    """yes when c IN members else no (NULL counts as not a member)."""
    return F.when(_c(c).cast("string").isin(*[str(m) for m in members]), yes).otherwise(no)


def space_default(c: ColumnOrName, default: ColumnOrName) -> Column:
    """CASE WHEN c = ' ' THEN default ELSE c END (no fall-back when c is NULL)."""
    return F.when(_c(c) == BLANK, _c(default)).otherwise(_c(c))


def pipe_key(*cols: ColumnOrName) -> Column:
    """Composite relationship key joined by '|'; NULL when any part is NULL."""
    parts = [_c(c).cast("string") for c in cols]
    return F.when(F.greatest(*[p.isNull() for p in parts]) if len(parts) > 1 else parts[0].isNull(),
                  F.lit(None).cast("string")).otherwise(F.concat_ws("|", *parts))


def when_in(status: ColumnOrName, values: Iterable, value: ColumnOrName) -> Column:
    """CASE WHEN status IN (...) THEN value END."""
    return F.when(_c(status).isin(*list(values)), _c(value))


def null_safe_key(c: ColumnOrName, fill: str = BLANK) -> Column:
    """NVL(key, ' ') so merge keys never hold NULL (T6, MRG-09)."""
    return F.coalesce(_c(c).cast("string"), F.lit(fill))
