"""Reusable relational blocks the data products are built from.

Every block is a pure ``DataFrame -> DataFrame`` function.  Design rules, chosen
for a cluster where one key may hold a third of all rows:

* windows only run after a pre-aggregation that bounds the group size (distinct
  days, months), so a hot customer or serial cannot pin a task with raw rows;
* "first row by order" is an aggregate (``min(struct)``) with map-side partial
  aggregation, never a ``row_number`` over raw rows;
* correlated scalar look-ups are aggregated once per key and left-joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X


def _cols(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


# ---------------------------------------------------------------------------
# WIN-01 / AGG-02: n-th event day per group
# ---------------------------------------------------------------------------
def nth_event(df: DataFrame, group_cols, ts_col: str, n: int = 4,
              names: Sequence[str] | None = None, last_name: str = "last_day",
              count_name: str = "n_days") -> DataFrame:
    """1st..n-th distinct event **day** per group, the last day and the day count.

    Equivalent to ``DENSE_RANK() OVER (PARTITION BY g ORDER BY TRUNC(ts))`` followed
    by ``MIN(CASE WHEN rank = k THEN day END)``.  The dense rank over days equals a
    row number over distinct days, which is what is computed here after the
    ``distinct`` has shrunk every group to its number of distinct days.
    """
    g = _cols(group_cols)
    names = list(names or [f"day_{k}" for k in range(1, n + 1)])
    days = (df.select(*g, X.day(ts_col).alias("_day"))
              .where(F.col("_day").isNotNull())
              .distinct())
    ranked = days.withColumn(
        "_rk", F.dense_rank().over(Window.partitionBy(*g).orderBy(F.col("_day").asc())))
    aggs = [F.min(F.when(F.col("_rk") == k + 1, F.col("_day"))).alias(nm)
            for k, nm in enumerate(names)]
    aggs += [F.max("_day").alias(last_name), F.count(F.lit(1)).alias(count_name)]
    return ranked.groupBy(*g).agg(*aggs)


# ---------------------------------------------------------------------------
# AGG-03: MIN(x) KEEP (DENSE_RANK FIRST ORDER BY ...), MAX(x) KEEP (... LAST ...)
# ---------------------------------------------------------------------------
def first_last_by(df: DataFrame, group_cols, order_cols, value_col: str,
                  first_name: str = "first_value", last_name: str = "last_value") -> DataFrame:
    """First and last value per group by a composite order.

    Rows with a NULL order column are dropped first (in the source dialect they
    would sort last ascending, first descending; the products exclude them).
    ``min(struct(order..., value))`` picks MIN(value) among ties at the first
    order position, ``max(struct(...))`` picks MAX(value) among ties at the last:
    exactly KEEP FIRST/LAST.  Both are plain aggregates with partial
    aggregation, so a hot group never reaches one task as raw rows.
    """
    g, o = _cols(group_cols), _cols(order_cols)
    cond = F.lit(True)
    for c in o:
        cond = cond & F.col(c).isNotNull()
    v = F.col(value_col)
    order = [F.col(c).alias(f"_o{i}") for i, c in enumerate(o)]
    # MIN/MAX ignore NULL values among the tied rows: a NULL flag after the
    # order keys makes non-NULL values win the tie in both directions
    first = F.struct(*order, v.isNull().alias("_n"), v.alias("_v"))
    last = F.struct(*order, v.isNotNull().alias("_n"), v.alias("_v"))
    return (df.where(cond).groupBy(*g)
              .agg(F.min(first).getField("_v").alias(first_name),
                   F.max(last).getField("_v").alias(last_name)))


# ---------------------------------------------------------------------------
# WIN-04 / AGG-07 / WIN-05: trailing calendar months
# ---------------------------------------------------------------------------
def window_floor(cutoff: str, back: int) -> Column:
    """First month a trailing window of ``back`` months can reach from months
    at or after ``cutoff``: rows before it can never reach a kept month."""
    return F.add_months(F.trunc(F.lit(cutoff).cast("date"), "MM"), -back)


def monthly_sum(df: DataFrame, key_cols, date_col: str, value_col: str,
                month_name: str = "month_start", value_name: str = "qty",
                since: Column | None = None) -> DataFrame:
    """SUM(value) per key and calendar month (exact decimal sum).

    ``since`` (a month start, e.g. :func:`window_floor`) filters the raw date
    column before the aggregate: the predicate is on the physical column, so it
    reaches the Parquet scan and old history is never read.
    """
    k = _cols(key_cols)
    if since is not None:
        df = df.where(F.col(date_col) >= since.cast(df.schema[date_col].dataType))
    return (df.select(*k, X.month_start(date_col).alias(month_name),
                      X.money(df, value_col).alias("_v"))
              .groupBy(*k, month_name).agg(F.sum("_v").alias(value_name)))


def trailing_months(monthly: DataFrame, key_cols, month_col: str, value_col: str,
                    back: int = 6, skip: int = 1, out: str = "trailing",
                    cutoff=None) -> DataFrame:
    """SUM over the months [m-back, m-skip] of the same key, gap-aware.

    ``RANGE BETWEEN INTERVAL 'back' MONTH PRECEDING AND INTERVAL 'skip' MONTH
    PRECEDING`` on a month ordinal: missing months are simply absent, and a
    month with no prior month in range gets NULL (not 0).  The input is already
    one row per (key, month), so a window group holds at most the number of
    months of history.  ``cutoff`` is applied **after** the window (WIN-05):
    early kept months still see older history.
    """
    k = _cols(key_cols)
    w = (Window.partitionBy(*k).orderBy(X.month_index(month_col))
         .rangeBetween(-back, -skip))
    res = monthly.withColumn(out, F.sum(F.col(value_col)).over(w))
    if cutoff is not None:
        res = res.where(F.col(month_col) >= F.lit(cutoff).cast("date"))
    return res


# ---------------------------------------------------------------------------
# WIN-03 / AGG-09: previous event day per serial
# ---------------------------------------------------------------------------
def previous_event(df: DataFrame, key_col: str, ts_col: str, prev_name: str = "prev_day",
                   day_name: str = "day", exclude_blank: bool = True) -> DataFrame:
    """(key, day, previous distinct day of the same key).

    The LAG runs on DISTINCT (key, day) pairs, replacing an O(n^2) inequality
    self-join.  NULL and blank keys are excluded before the window: they are the
    natural hot key (every row without a serial) and never get a previous day.
    """
    pairs = df.select(F.col(key_col), X.day(ts_col).alias(day_name))
    if exclude_blank:
        pairs = pairs.where(F.col(key_col).isNotNull() & (F.trim(F.col(key_col).cast("string")) != ""))
    pairs = pairs.where(F.col(day_name).isNotNull()).distinct()
    w = Window.partitionBy(key_col).orderBy(F.col(day_name).asc())
    return pairs.withColumn(prev_name, F.lag(day_name).over(w))


# ---------------------------------------------------------------------------
# AGG-05: share allocation
# ---------------------------------------------------------------------------
def line_counts(lines: DataFrame, note_keys, name: str = "n_lines") -> DataFrame:
    """COUNT(*) of lines per note, over **all** lines (before any filter)."""
    k = _cols(note_keys)
    return lines.groupBy(*k).agg(F.count(F.lit(1)).alias(name))


def allocate_share(lines: DataFrame, counts: DataFrame, note_keys, amount: Column,
                   share_name: str = "share", count_name: str = "n_lines") -> DataFrame:
    """Attach ``amount / NULLIF(line count, 0)`` to every line.

    The counts are a grouped pre-aggregate joined back on the note key instead
    of a ``COUNT(*) OVER (PARTITION BY note)`` window: a note with a huge number
    of lines is combined map-side, and AQE splits the skewed join partition.
    """
    k = _cols(note_keys)
    j = lines.join(counts, on=k, how="left")
    return j.withColumn(share_name, X.safe_div(amount, F.col(count_name)))


# ---------------------------------------------------------------------------
# JON-12 / AGG-06 / AGG-08: per-key and per-month totals attached to rows
# ---------------------------------------------------------------------------
def attach_month_total(df: DataFrame, key_cols, date_col: str, value_col: str,
                       name: str = "month_total") -> DataFrame:
    """Month-wide total of the row's key attached to each day row (AGG-08)."""
    k = _cols(key_cols)
    withm = df.withColumn("_m", X.month_start(date_col))
    v = X.money(df, value_col)
    tot = withm.groupBy(*k, "_m").agg(F.sum(v).alias(name))
    return withm.join(tot, on=[*k, "_m"], how="left").drop("_m")


# ---------------------------------------------------------------------------
# JON-13: exact-date look-up with latest fallback
# ---------------------------------------------------------------------------
def lookup_exact_or_latest(facts: DataFrame, lookup: DataFrame, keys, fact_day: Column,
                           lookup_day: Column, value: Column, name: str) -> DataFrame:
    """``NVL(MAX(value) at the same day, MAX(value) over all days)`` per fact row.

    Two grouped pre-aggregates (per key+day and per key) and two left joins; the
    look-up side is reduced before any shuffle with the facts.  The join per key comes
    first: facts that lie by key already do not move for it.
    """
    k = _cols(keys)
    lk = lookup.select(*k, lookup_day.alias("_d"), value.alias("_v"))
    exact = lk.groupBy(*k, "_d").agg(F.max("_v").alias("_exact"))
    latest = lk.groupBy(*k).agg(F.max("_v").alias("_latest"))
    f = facts.withColumn("_d", fact_day)
    return (f.join(latest, on=k, how="left")
             .join(exact, on=[*k, "_d"], how="left")
             .withColumn(name, F.coalesce("_exact", "_latest"))
             .drop("_d", "_exact", "_latest"))


# ---------------------------------------------------------------------------
# SET-01 / PRJ-04: tagged union of blocks of different shape
# ---------------------------------------------------------------------------
def union_blocks(blocks: Sequence[DataFrame], columns: Sequence[tuple[str, str]]) -> DataFrame:
    """UNION ALL of blocks padded to one typed row shape.

    ``columns`` is the output shape ``[(name, spark_type), ...]``; a block that
    lacks a column gets a typed NULL, every column is cast to its declared type.
    """
    out = None
    for b in blocks:
        have = set(b.columns)
        sel = [(F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in columns]
        part = b.select(*sel)
        out = part if out is None else out.unionByName(part)
    return out


# ---------------------------------------------------------------------------
# AGG-01 / AGG-11: unit scaling of grouped sums
# ---------------------------------------------------------------------------
def scaled_sum(df: DataFrame, group_cols, value_col: str, unit_col: str,
               other_col: str | None = None, name: str = "minutes",
               product_name: str = "product") -> DataFrame:
    """Grouped SUM scaled by unit, and optionally the product of two sums."""
    g = _cols(group_cols)
    aggs = [F.sum(X.money(df, value_col)).alias("_s")]
    if other_col:
        aggs.append(F.sum(X.money(df, other_col)).alias("_o"))
    r = df.groupBy(*g, unit_col).agg(*aggs)
    r = r.withColumn(name, X.scale_to_minutes(F.col("_s").cast("double"), unit_col))
    if other_col:
        r = r.withColumn(product_name, F.col(name) * F.col("_o").cast("double"))
    return r.withColumnRenamed("_s", "sum_value").drop("_o")
