"""Trailing months kept up to date by what a merge changed (AGG-07, WIN-04).

A full rebuild reads all history to sum the months and to slide the window.  Here the
monthly sums are a table of their own (sum, number of values, number of rows).  A merge
hands over the rows it took out and those it put in; their months are summed with a
sign and added to the kept sums, so a row that moves from one month to another leaves the
first and joins the second.  A trailing sum changes only where a changed month lies in its
window: those (key, month) pairs are listed, recomputed from the months of their keys, and
put in place of the old ones.  Sums are those of :func:`blocks.monthly_sum` (decimals exact),
so the result is the same as a rebuild, row by row.

Only the changed months and the keys they belong to are shuffled beyond the joins with the
list of changes, which is as small as the merge; the rest passes through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as X
from .blocks import trailing_months

VALUES, ROWS = "n_values", "n_rows"


def _cols(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _same(a: str, b: str, columns) -> Column:
    """Equal in all columns, NULL equal to NULL."""
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return cond


def _joined(left: DataFrame, right: DataFrame, columns, how: str) -> DataFrame:
    return left.alias("l").join(right.alias("r"), _same("l", "r", columns), how)


def monthly_state(df: DataFrame, key_cols, date_col: str, value_col: str, month_name: str = "month_start",
                  value_name: str = "qty") -> DataFrame:
    """``(keys, month, sum, n_values, n_rows)``: the sums to keep."""
    k = _cols(key_cols)
    return (df.select(*k, X.month_start(date_col).alias(month_name), X.money(df, value_col).alias("_v"))
            .groupBy(*k, month_name).agg(F.sum("_v").alias(value_name), F.count("_v").alias(VALUES), F.count(F.lit(1)).alias(ROWS)))


def monthly_change(removed: DataFrame, added: DataFrame, key_cols, date_col: str, value_col: str,
                   month_name: str = "month_start", value_name: str = "qty") -> DataFrame:
    """What a merge adds to the kept sums: rows taken out count negatively.  Months whose
    rows only changed in other columns cancel and are left out."""
    k = _cols(key_cols)
    out = monthly_state(removed, k, date_col, value_col, month_name, value_name)
    into = monthly_state(added, k, date_col, value_col, month_name, value_name)
    kind = into.schema[value_name].dataType
    signed = out.select(*k, month_name, (-F.col(value_name)).cast(kind).alias(value_name), (-F.col(VALUES)).alias(VALUES), (-F.col(ROWS)).alias(ROWS)).unionByName(into)
    total = signed.groupBy(*k, month_name).agg(F.sum(F.coalesce(value_name, F.lit(0).cast(kind))).cast(kind).alias(value_name),
                                               F.sum(VALUES).alias(VALUES), F.sum(ROWS).alias(ROWS))
    return total.where((F.col(value_name) != 0) | (F.col(VALUES) != 0) | (F.col(ROWS) != 0))


def apply_change(state: DataFrame, change: DataFrame, key_cols, month_name: str = "month_start", value_name: str = "qty") -> DataFrame:
    """The kept sums after the change; a month without rows is gone, one without values
    has a NULL sum."""
    at = [*_cols(key_cols), month_name]
    kind = state.schema[value_name].dataType
    old = _joined(state, change, at, "left_semi").withColumn(value_name, F.coalesce(value_name, F.lit(0).cast(kind)))
    new = old.unionByName(change.select(*state.columns)).groupBy(*at).agg(F.sum(value_name).cast(kind).alias(value_name), F.sum(VALUES).alias(VALUES), F.sum(ROWS).alias(ROWS))
    new = new.where(F.col(ROWS) > 0).withColumn(value_name, F.when(F.col(VALUES) > 0, F.col(value_name)))
    return _joined(state, change, at, "left_anti").unionByName(new.select(*state.columns))


def windows_in_reach(change: DataFrame, key_cols, month_name: str = "month_start", back: int = 6, skip: int = 1) -> DataFrame:
    """The (key, month) pairs whose row or trailing window a change can touch."""
    k = _cols(key_cols)
    steps = F.array_union(F.array(F.lit(0)), F.sequence(F.lit(skip), F.lit(back)))
    return (change.select(*k, month_name, F.explode(steps).alias("_step"))
            .select(*k, F.add_months(month_name, F.col("_step")).alias(month_name)).distinct())


def refresh_trailing(trailing: DataFrame, state: DataFrame, change: DataFrame, key_cols, month_name: str = "month_start",
                     value_name: str = "qty", back: int = 6, skip: int = 1, out: str = "trailing") -> DataFrame:
    """The trailing table after a change: rows out of reach as they are, the others from
    the new ``state`` (after :func:`apply_change`)."""
    k = _cols(key_cols)
    reach = windows_in_reach(change, k, month_name, back, skip)
    mine = _joined(state, change.select(*k).distinct(), k, "left_semi").select(*k, month_name, value_name)
    fresh = _joined(trailing_months(mine, k, month_name, value_name, back, skip, out), reach, [*k, month_name], "left_semi")
    return _joined(trailing, reach, [*k, month_name], "left_anti").unionByName(fresh.select(*trailing.columns))
