"""Comparing two versions of a table, or its keys with those of the source, by digests of
key ranges (REC-05, SET-02, MRG-05, SRC-09).

A content comparison that shuffles both tables costs the same whether one row differs
or all do.  Here every row falls into one of ``COARSE * FINE`` ranges of its hashed key,
and a range is summed up, whatever the order of its rows, by their number, the xor and
the sums of their hashes.  Ranges are compared in two levels: the coarse ones of both
sides first, then the fine ones within the coarse ones that differ.  Only rows in fine
ranges that differ go on to the exact comparison, :func:`reconcile.symmetric_diff`.

What is broadcast has a size bound that does not depend on the tables: one word for each
coarse range that differs, and one bit for each fine range within those
(``COARSE * FINE`` bits, 2 MB).  Digests combine map-side, so a level shuffles at most one
row per task and range, and rows of equal ranges are never shuffled.  Equal digests of
different contents need a collision of 64 bits of xor, two 32-bit sums and a count; unequal
digests of equal contents (a row held twice on one side, under MINUS) only send rows to the
exact comparison in vain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .merge import MergeError
from .reconcile import symmetric_diff, tasks_for

COARSE, FINE, WORD = 4096, 4096, 64
SUMS = ["_n", "_x", "_hi", "_lo"]


def _canonical(df: DataFrame, c: str) -> Column:
    """A value whose hash is equal where the values are: -0.0 as 0.0, every NaN alike."""
    x = F.col(f"`{c}`")
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        return F.when(F.isnan(x), F.lit(float("nan"))).when(x == 0, F.lit(0.0)).otherwise(x.cast("double"))
    return x


def row_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """64-bit hash of a row; which columns are NULL is part of it."""
    nulls = F.concat(*[F.when(F.col(f"`{c}`").isNull(), F.lit("1")).otherwise(F.lit("0")) for c in columns])
    return F.xxhash64(nulls, *[_canonical(df, c) for c in columns])


def _placed(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows with their coarse and fine range and their hash."""
    place = row_hash(df, keys)
    return (df.withColumn("_place", place)
            .withColumn("_coarse", F.pmod(F.col("_place"), F.lit(COARSE)).cast("int"))
            .withColumn("_fine", F.pmod(F.shiftright("_place", 20), F.lit(FINE)).cast("int"))
            .withColumn("_hash", row_hash(df, columns)).drop("_place"))


def _digests(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """Ranges whose digests differ.  One aggregation over the tagged union: side b counts
    negatively, so equal ranges add up to zero."""
    def side(df: DataFrame, sign: int) -> DataFrame:
        s = F.lit(sign).cast("long")
        return df.select(*by, s.alias("_n"), F.col("_hash").alias("_x"), (s * F.shiftright("_hash", 32)).alias("_hi"),
                         (s * F.col("_hash").bitwiseAND(F.lit(0xFFFFFFFF))).alias("_lo"))
    both = side(a, 1).unionByName(side(b, -1))
    total = both.groupBy(*by).agg(F.sum("_n").alias("_n"), F.bit_xor("_x").alias("_x"), F.sum("_hi").alias("_hi"), F.sum("_lo").alias("_lo"))
    return total.where(" OR ".join(f"{c} <> 0" for c in SUMS)).select(*by)


def differing_ranges(pa: DataFrame, pb: DataFrame) -> DataFrame:
    """``(_coarse, _word, _bits)``: one bit for each fine range of two placed sides whose
    contents differ, at most ``COARSE * FINE / WORD`` rows."""
    coarse = _digests(pa, pb, ["_coarse"])                           # at most COARSE rows

    def in_coarse(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(coarse), "_coarse", "left_semi")

    fine = _digests(in_coarse(pa), in_coarse(pb), ["_coarse", "_fine"])
    return (fine.groupBy("_coarse", F.floor(F.col("_fine") / WORD).cast("int").alias("_word"))
            .agg(F.bit_or(F.expr(f"shiftleft(1L, _fine % {WORD})")).alias("_bits")))


def marked(placed: DataFrame, words: DataFrame, name: str = "_differs") -> DataFrame:
    """Placed rows with whether their fine range differs; a broadcast, no shuffle."""
    tested = placed.withColumn("_word", F.floor(F.col("_fine") / WORD).cast("int")).join(F.broadcast(words), ["_coarse", "_word"], "left")
    return tested.withColumn(name, F.coalesce(F.expr(f"shiftright(_bits, _fine % {WORD}) & 1L = 1L"), F.lit(False)))


def differing_rows(a: DataFrame, b: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides (``columns``) in key ranges whose contents differ."""
    pa, pb = _placed(a, keys, columns), _placed(b, keys, columns)
    words, cols = differing_ranges(pa, pb), [F.col(f"`{c}`") for c in columns]
    return marked(pa, words).where("_differs").select(*cols), marked(pb, words).where("_differs").select(*cols)


def digest_diff(a: DataFrame, b: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None,
                strict: bool = False, side_col: str = "side") -> DataFrame:
    """:func:`reconcile.symmetric_diff` of two versions of a table with few differences.
    ``keys`` place a row in a range; they need not be unique or free of NULLs.  Three
    scans of each side, and a shuffle of the differing ranges only."""
    cols = list(columns or a.columns)
    left, right = differing_rows(a, b, list(keys), cols)
    return symmetric_diff(left, right, cols, strict, side_col)


def range_sweep(target: DataFrame, universe: DataFrame, keys: Sequence[str], scope: Column | None = None,
                allow_empty_universe: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(kept, removed)`` of :func:`merge.orphan_sweep`, in two phases (MRG-05, SRC-09).

    The keys of the rows in ``scope`` and those of the source are compared by ranges.
    Where a range is equal, all its rows are live; rows of the other ranges are suspects,
    and only they are joined with the key universe (its keys of those ranges).  A sweep
    that finds few orphans shuffles few rows of the target, which is read three times (twice
    its key and scope columns only).
    """
    k, in_scope = list(keys), F.lit(True) if scope is None else F.coalesce(scope, F.lit(False))
    u = universe.select(*k).dropna()
    live = u.count()
    if not allow_empty_universe and live == 0:
        raise MergeError("refusing to sweep against an empty key universe")
    # as many tasks as the keys ask for: what a task holds does not grow with the tables
    tasks = tasks_for(target.sparkSession, live)
    u = u.withColumn("_key", row_hash(u, k)).repartition(tasks, "_key").groupBy("_key", *k).agg(F.lit(1).alias("_one")).select(*k)
    columns = [F.col(f"`{c}`") for c in target.columns]
    # keys compare as the target has them; one that its type cannot hold is not there
    for c in k:
        if u.schema[c].dataType != target.schema[c].dataType:
            u = u.withColumn("_was", F.col(c)).withColumn(c, F.col(c).try_cast(target.schema[c].dataType)).where(F.col("_was") == F.col(c)).drop("_was")
    placed = _placed(target.withColumn("_in", in_scope), k, k)
    source = _placed(u, k, k)
    words = differing_ranges(placed.where("_in"), source)
    tested = marked(placed, words).withColumn("_suspect", F.col("_in") & F.col("_differs"))
    known = marked(source, words).where("_differs").select(*k)
    suspects = tested.where("_suspect").select(*columns)
    kept = tested.where(~F.col("_suspect")).select(*columns).unionByName(suspects.join(known, on=k, how="left_semi").select(*columns))
    return kept, suspects.join(known, on=k, how="left_anti").select(*columns)
