"""Drift of column types between a batch and its target (SNK-09).

Types form a partial order by "holds every value of": whole numbers by width, decimals by
digits before and after the point, ``date`` below ``timestamp_ntz``, whole numbers of up
to 32 bits and floats below ``double``.  Text is apart: a number that turns into text
sorts and compares otherwise, so it is no widening.

Policies for a column whose type differs:

* ``fail``: refused;
* ``widen``: the target takes the least type that holds both, refused if there is none;
  a batch of a smaller type is read as the target's, nothing is narrowed;
* ``lossless``: as ``widen`` where there is such a type; else the batch is cast to the
  target's type if every value of it comes back unchanged, which one aggregate over the
  batch counts, and refused otherwise.

New columns are refused by ``fail`` and kept (NULL in older rows) by the others; columns
the batch lacks are refused by ``fail`` and NULL by the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schema import SchemaDriftError

POLICIES = ("fail", "widen", "lossless")
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_EXACT_IN = {T.FloatType: (T.ByteType, T.ShortType), T.DoubleType: (T.ByteType, T.ShortType, T.IntegerType, T.FloatType)}
_FAMILIES = (T.NumericType, (T.DateType, T.TimestampNTZType))


def common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The least type that holds every value of both, or None."""
    if a == b:
        return a
    for x, y in ((a, b), (b, a)):
        if type(x) in _DIGITS and type(y) in _DIGITS and _DIGITS[type(x)] <= _DIGITS[type(y)]:
            return y
        if type(x) in _EXACT_IN.get(type(y), ()):
            return y
        if isinstance(x, T.DateType) and isinstance(y, T.TimestampNTZType):
            return y
    if isinstance(a, T.FloatType) and isinstance(b, T.IntegerType) or isinstance(b, T.FloatType) and isinstance(a, T.IntegerType):
        return T.DoubleType()
    shapes = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS.get(type(t)), 0) for t in (a, b)]
    if all(whole is not None for whole, _ in shapes):
        whole, scale = max(w for w, _ in shapes), max(s for _, s in shapes)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    return None


def _convertible(old: T.DataType, new: T.DataType) -> bool:
    """Whether a cast between the two can keep a value at all."""
    text = isinstance(old, T.StringType) or isinstance(new, T.StringType)
    return text and isinstance(old, T.AtomicType) and isinstance(new, T.AtomicType) or any(isinstance(old, f) and isinstance(new, f) for f in _FAMILIES)


def is_lost(c: Column, old: T.DataType, new: T.DataType) -> Column:
    """True where a value of type ``new`` does not come back from ``old`` unchanged."""
    if not _convertible(old, new):
        return c.isNotNull()
    back = c.try_cast(old).try_cast(new)
    return c.isNotNull() & (back.isNull() | (back != c))


def _plan(batch: T.StructType, target: T.StructType, policy: str) -> list[tuple[str, T.DataType | None, T.DataType | None, T.DataType | None, str]]:
    """``(column, old type, new type, resulting type, action)``; the action ``check``
    depends on the data."""
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy}")
    out, strict = [], policy == "fail"
    for f in target.fields:
        old, new = f.dataType, batch[f.name].dataType if f.name in batch.names else None
        if new is None:
            out.append((f.name, old, None, old, "refused" if strict else "missing"))
        elif new == old:
            out.append((f.name, old, new, old, "same"))
        elif strict:
            out.append((f.name, old, new, None, "refused"))
        elif (both := common_type(old, new)) is not None:
            out.append((f.name, old, new, both, "kept" if both == old else "widened"))
        else:
            out.append((f.name, old, new, None, "refused") if policy == "widen" else (f.name, old, new, old, "check"))
    out += [(f.name, None, f.dataType, f.dataType, "refused" if strict else "added") for f in batch.fields if f.name not in target.names]
    return out


def drift_report(batch: DataFrame, target: T.StructType, policy: str) -> DataFrame:
    """One row per column: ``column_name, old_type, new_type, target_type, action,
    lost_rows``.  ``lost_rows`` counts the values that the target's type would change,
    where the policy looks at them; one aggregate over the batch, nothing is collected."""
    plan = _plan(batch.schema, target, policy)
    checked = [p for p in plan if p[4] == "check"]
    lost = [F.count_if(is_lost(F.col(f"`{name}`"), old, new)).alias(f"_lost{i}") for i, (name, old, new, _, _) in enumerate(checked)]
    place = {p[0]: i for i, p in enumerate(checked)}
    rows = []
    for name, old, new, to, action in plan:
        n = F.col(f"_lost{place[name]}") if action == "check" else F.lit(None).cast("long")
        refused = n > 0 if action == "check" else F.lit(action == "refused")
        done = "narrowed" if action == "check" else action
        rows.append(F.struct(
            F.lit(name).alias("column_name"), F.lit(old and old.simpleString()).cast("string").alias("old_type"),
            F.lit(new and new.simpleString()).cast("string").alias("new_type"),
            F.when(~refused, F.lit(to and to.simpleString())).cast("string").alias("target_type"),
            F.when(refused, "refused").otherwise(done).alias("action"), n.alias("lost_rows")))
    return batch.agg(F.count(F.lit(1)).alias("_n"), *lost).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def align_types(batch: DataFrame, target: DataFrame, policy: str) -> tuple[DataFrame, DataFrame]:
    """Batch and target with one schema under the policy; raises
    :class:`SchemaDriftError` with the refused columns before anything is written."""
    plan = _plan(batch.schema, target.schema, policy)
    refused = [f"{n} ({o and o.simpleString()} to {b and b.simpleString()})" for n, o, b, _, action in plan if action == "refused"]
    if not refused and any(action == "check" for *_, action in plan):
        rows = drift_report(batch, target.schema, policy).where("action = 'refused'").collect()      # one row per column
        refused = [f"{r['column_name']} ({r['old_type']} to {r['new_type']}, {r['lost_rows']} values change)" for r in rows]
    if refused:
        raise SchemaDriftError(f"schema drift under {policy}: {', '.join(refused)}")

    def shaped(df: DataFrame) -> DataFrame:
        return df.select(*[(F.col(f"`{n}`") if n in df.columns else F.lit(None)).cast(to).alias(n) for n, _, _, to, _ in plan])
    return shaped(batch), shaped(target)
