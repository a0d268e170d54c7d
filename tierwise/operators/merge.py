"""Keyed merge, deduplication and scoped orphan removal over DataFrames.

Parquet has no MERGE statement, so a merge is expressed as relational algebra
and the result is written as a new table version by the store
(:mod:`tierwise.sources.store`):

    merged = target LEFT ANTI JOIN batch ON keys  UNION ALL  dedup(batch)

The anti-join is a single shuffle (or none when AQE sees a small batch and
broadcasts it); the union adds no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X


class MergeError(ValueError):
    pass


def _cols(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


# ---------------------------------------------------------------------------
# MRG-02: dedup by key, first row in a given order
# ---------------------------------------------------------------------------
def dedup_first(df: DataFrame, keys, order: Sequence[str] | None = None,
                descending: bool = False) -> DataFrame:
    """Keep one row per key: the first by ``order``, ties broken by every other
    column (ascending, NULLs first): a total order.

    Equivalent to ``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order ASC NULLS
    LAST, <other columns> ASC NULLS FIRST) = 1``.  Keys are counted first (keys
    only, combined before the shuffle); rows of a key that occurs once pass through
    as they are, and only rows of repeated keys reach the tie-break, a
    ``min(struct)`` per key that collapses a hot key on every mapper.  The result
    does not depend on partitioning (retries give the same rows).
    ``descending=True`` orders ``order`` DESC NULLS FIRST ("latest wins").
    """
    k = _cols(keys)
    order = list(order or [])
    rest = [c for c in df.columns if c not in k and c not in order]
    fields: list[Column] = []
    out: dict[str, str] = {}
    for i, c in enumerate(order):
        x = F.col(c)
        if descending:
            # DESC NULLS FIRST: NULLs first, then an order-reversing twin; the raw
            # value rides along (the twin is one-to-one, so order is unchanged)
            fields += [x.isNotNull().alias(f"_n{i}"), _desc_key(df, c).alias(f"_k{i}"), x.alias(f"_r{i}")]
            out[c] = f"_r{i}"
        else:
            fields += [x.isNull().alias(f"_n{i}"), x.alias(f"_k{i}")]
            out[c] = f"_k{i}"
    for j, c in enumerate(rest):
        fields.append(F.col(c).alias(f"_t{j}"))
        out[c] = f"_t{j}"
    repeated = df.groupBy(*k).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*[F.col(c).alias(f"_rep{i}") for i, c in enumerate(k)])
    same = F.lit(True)
    for i, c in enumerate(k):
        same = same & F.col(c).eqNullSafe(F.col(f"_rep{i}"))
    single = df.join(repeated, same, "left_anti")
    # every non-key column is part of the order, so the struct is also the payload
    agg = df.join(repeated, same, "left_semi").groupBy(*k).agg(F.min(F.struct(*fields)).alias("_best"))
    return single.unionByName(agg.select(*[F.col(c) if c in k else F.col(f"_best.{out[c]}").alias(c) for c in df.columns]))


def _desc_key(df: DataFrame, c: str) -> Column:
    t = df.schema[c].dataType.typeName()
    x = F.col(c)
    if t in ("integer", "long", "short", "byte", "double", "float", "decimal"):
        return -x
    if t in ("timestamp", "timestamp_ntz", "date"):
        # epoch - x is an orderable day-time interval: descending x, TZ-free
        epoch = "1970-01-01" if t == "date" else "1970-01-01 00:00:00"
        return F.lit(epoch).cast(df.schema[c].dataType) - x
    if t == "string":
        # code points mirrored, then a mark above all of them: a prefix sorts after its longer forms
        return F.concat(F.transform(F.split(x, ""), lambda ch: F.lit(0x10FFFF) - F.ascii(ch)), F.array(F.lit(0x110000)))
    raise MergeError(f"descending dedup order needs a text, numeric or date column, got {c}: {t}")


# ---------------------------------------------------------------------------
# MRG-09 / MRG-10 / T6: key hygiene
# ---------------------------------------------------------------------------
def null_keys(df: DataFrame, keys) -> DataFrame:
    """Rows with a NULL in any key column (NULL never matches in a merge)."""
    k = _cols(keys)
    cond = F.lit(False)
    for c in k:
        cond = cond | F.col(c).isNull()
    return df.where(cond)


def fill_null_keys(df: DataFrame, keys, fill: str = X.BLANK) -> DataFrame:
    """NVL(key, ' ') on text keys (MRG-09)."""
    return df.withColumns({c: X.null_safe_key(c, fill) for c in _cols(keys)})


def key_grain_report(df: DataFrame, keys, name: str = "n_rows") -> DataFrame:
    """Keys carrying more than one row: the merge key is coarser than the grain."""
    k = _cols(keys)
    return df.groupBy(*k).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)


# ---------------------------------------------------------------------------
# MRG-01 / MRG-03 / MRG-04: upsert, insert-if-absent
# ---------------------------------------------------------------------------
def rows_to_apply(target: DataFrame, batch: DataFrame, keys, order: Sequence[str] | None = None,
                  descending: bool = False, reject_null_keys: bool = True, guard: str | None = None) -> DataFrame:
    """What a batch changes: one row per key in the target's shape (MRG-02).

    ``guard`` names a version column: a row whose version is older than that of the
    target's row with its key (or unknown, where that one has a version) is left out,
    so a late delivery never takes back a newer state.  Only the key and version
    columns of the target are read for it.
    """
    k = _cols(keys)
    if reject_null_keys and not null_keys(batch, k).isEmpty():
        raise MergeError(f"batch holds NULL merge keys in {k}")
    src = dedup_first(batch.dropna(subset=k), k, order, descending).select(*target.columns)
    if guard is None:
        return src
    held = target.select(*k, F.col(guard).alias("_held"))
    newer = F.col("_held").isNull() | F.coalesce(F.col(guard) >= F.col("_held"), F.lit(False))
    return src.join(held, on=k, how="left").where(newer).select(*target.columns)


def upsert(target: DataFrame, batch: DataFrame, keys, order: Sequence[str] | None = None,
           descending: bool = False, reject_null_keys: bool = True, guard: str | None = None) -> DataFrame:
    """Update matched keys, insert unmatched keys, never delete.

    The batch is deduplicated first (MRG-02).  Rows of the batch with a NULL key
    would be inserted again on every run (NULL never matches), so by default
    they are refused (T6); pass ``reject_null_keys=False`` to drop them instead.
    Columns are aligned by name to the target's shape.  ``guard``: see
    :func:`rows_to_apply`.
    """
    return replace_rows(target, rows_to_apply(target, batch, keys, order, descending, reject_null_keys, guard), keys)


def replace_rows(target: DataFrame, src: DataFrame, keys) -> DataFrame:
    """The target with the rows of ``src`` (one per key, same shape) in place of its own."""
    k = _cols(keys)
    return target.join(src.select(*k), on=k, how="left_anti").unionByName(src)


def insert_if_absent(target: DataFrame, batch: DataFrame, keys) -> DataFrame:
    """Key-only tables: insert new keys, no update part (MRG-03); idempotent."""
    k = _cols(keys)
    new = batch.select(*target.columns).dropna(subset=k).dropDuplicates(k)
    return target.unionByName(new.join(target.select(*k), on=k, how="left_anti"))


# ---------------------------------------------------------------------------
# MRG-05 / MRG-06 / MRG-08: scoped orphan sweep
# ---------------------------------------------------------------------------
def orphan_sweep(target: DataFrame, universe: DataFrame, keys, scope: Column | None = None,
                 allow_empty_universe: bool = False) -> tuple[DataFrame, DataFrame]:
    """Remove target rows whose key is absent from the source key universe.

    Only rows inside ``scope`` (the caller's own slice of a multi-writer table)
    are candidates; rows outside it are kept untouched.  An empty universe almost
    always means a failed key read, so it is refused unless explicitly allowed.
    Returns ``(kept, removed)``.
    """
    k = _cols(keys)
    u = universe.select(*k).dropna().distinct()
    if not allow_empty_universe and u.isEmpty():
        raise MergeError("refusing to sweep against an empty key universe")
    in_scope = F.lit(True) if scope is None else F.coalesce(scope, F.lit(False))
    # one pass over the target: a left join marks the live keys
    marked = target.withColumn("_in", in_scope).join(u.withColumn("_live", F.lit(True)), on=k, how="left")
    live = F.coalesce(F.col("_live"), F.lit(False))
    kept = marked.where(~F.col("_in") | live).select(*target.columns)
    return kept, marked.where(F.col("_in") & ~live).select(*target.columns)


# ---------------------------------------------------------------------------
# MRG-11: tie-break preferring a reference table
# ---------------------------------------------------------------------------
def tie_break_reference(df: DataFrame, group_cols, candidate_col: str, reference: DataFrame,
                        ref_cols: Sequence[str] | None = None) -> DataFrame:
    """One row per group: prefer a candidate listed in ``reference``, then the
    smallest candidate.  ``ORDER BY priority ASC, candidate ASC`` + ROW_NUMBER,
    expressed as a ``min(struct)`` aggregate; the helper priority is dropped.
    """
    g = _cols(group_cols)
    rc = list(ref_cols or [*g, candidate_col])
    ref = reference.select(*rc).distinct().withColumn("_pref", F.lit(0))
    j = df.join(ref, on=rc, how="left").withColumn("_prio", F.coalesce("_pref", F.lit(1)))
    rest = [c for c in df.columns if c not in g]
    best = F.min(F.struct(F.col("_prio"), F.col(candidate_col).isNull(), F.col(candidate_col),
                          F.struct(*[F.col(c) for c in rest]).alias("_p"))).alias("_b")
    return (j.groupBy(*g).agg(best)
             .select(*g, *[F.col(f"_b._p.{c}").alias(c) for c in rest])
             .select(*df.columns))
