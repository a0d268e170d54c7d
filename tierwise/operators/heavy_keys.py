"""Left joins whose left side holds heavy and empty keys (JON-01, DP-21).

A serial number that stands for "unknown" may hold a third of a fact's rows: a plain
join sends all of them to one task.  Here

* rows whose key holds a NULL, or a text the caller names as no key, match nothing and
  bypass the join;
* keys with more than ``1 / shares`` of the other rows are heavy.  They are fewer than
  ``shares``, whatever the data, so the list of them may be broadcast;
* rows of heavy keys are dealt over ``salts`` parts and the right rows of those keys are
  repeated for each; all other rows stay in part 0 and are not repeated.

The part of a row follows from its content and its input partition, so a task that runs
again deals alike, and rows that are wholly equal spread where they lie in several
partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHARES = 1000
SALTS = 32


def heavy_keys(df: DataFrame, keys: Sequence[str], shares: int = SHARES) -> DataFrame:
    """Keys that hold more than ``1 / shares`` of the rows: fewer than ``shares`` of them."""
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return n.where(F.col("_n") * F.lit(shares) > n.agg(F.sum("_n")).scalar()).select(*keys)


def _no_key(df: DataFrame, keys: Sequence[str], empty: Sequence[str]) -> Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
        if empty and isinstance(df.schema[k].dataType, T.StringType):
            cond = cond | F.col(k).isin(*empty)
    return cond


def _content(df: DataFrame) -> list[str]:
    """Columns that have a hash."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.VariantType)]


def heavy_left_join(left: DataFrame, right: DataFrame, keys: Sequence[str], empty: Sequence[str] = (),
                    shares: int = SHARES, salts: int = SALTS, counted: DataFrame | None = None, bypass: bool = True) -> DataFrame:
    """``left.join(right, keys, "left")`` with heavy keys dealt by salt.

    ``empty`` lists texts that are no key (a blank, zeros): rows with one of them match
    nothing, like NULL; leave it out where such a text does match.  Both sides name the
    keys alike and share no other column.  Columns: those of ``left``, then the others
    of ``right``.  ``left`` is read three times (keys, keyed rows, empty rows); where that
    costs a join, ``counted``, a frame of the same keys, stands in for its keys, and without
    ``bypass`` rows that match nothing are dealt by salt beside the others."""
    keys = list(keys)
    extra = [c for c in right.columns if c not in keys]
    if clash := sorted(set(extra) & set(left.columns)):
        raise ValueError(f"both sides have {clash}")
    if salts < 1 or shares < 1:
        raise ValueError("shares and salts are at least 1")
    no_key = _no_key(left, keys, empty)
    keyed = left.where(~no_key) if bypass else left
    sized = left if counted is None else counted
    sized = sized.where(~_no_key(sized, keys, empty))
    heavy = F.broadcast(heavy_keys(sized, keys, shares).withColumn("_heavy", F.lit(True)))
    part = F.pmod(F.xxhash64(F.spark_partition_id(), *_content(left)), F.lit(salts)).cast("int")
    dealt = keyed.withColumn("_part", part).join(heavy, keys, "left")
    spread = F.col("_heavy") if bypass else F.col("_heavy") | no_key
    dealt = dealt.withColumn("_part", F.when(spread, F.col("_part")).otherwise(0)).drop("_heavy")
    parts = F.when(F.col("_heavy"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    copies = (right.where(~_no_key(right, keys, empty)).join(heavy, keys, "left")
              .withColumn("_part", F.explode(parts)).drop("_heavy"))
    joined = dealt.join(copies, [*keys, "_part"], "left").select(*left.columns, *extra)
    if not bypass:
        return joined
    alone = left.where(no_key).select(*left.columns, *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in extra])
    return joined.unionByName(alone)
