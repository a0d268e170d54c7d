"""Validity intervals attached to moments by a sweep (JON-11, T11).

``start <= moment <= end`` summed over all matching intervals equals what started up
to the moment less what ended before it.  Both are running sums over one order of
events, so no interval is expanded and no reading is compared with an interval: the
cost does not depend on how long the intervals are, and an end of 9999-12-31 costs
what any other end costs.

The running sum has two levels, so that a hot key splits: the rates are summed per key
and block of time and those sums are accumulated per key (at most one row a block of the
calendar); within each (key, block) only the distinct moments are accumulated.  Readings
of one moment collapse before the shuffle, and the result is joined back on (key,
moment), an equality join with at most one partner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as X

#: Order of what happens at one moment: intervals that start then hold, those that end then still hold.
STARTS, READING, ENDS = 0, 1, 2


def _cols(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def rate_events(rates: DataFrame, keys, start_col: str, end_col: str, rate_col: str) -> DataFrame:
    """``(keys, _ts, _kind, _delta)``: the rate added at each start and taken back after
    each end.  Rows with a null key or border, or that end before they start, hold at no
    moment."""
    k = _cols(keys)
    s, e = F.col(start_col).cast("timestamp_ntz"), F.col(end_col).cast("timestamp_ntz")
    held = rates.select(*k, s.alias("_s"), e.alias("_e"), X.money(rates, rate_col).alias("_r")).where(F.col("_s") <= F.col("_e")).dropna(subset=k)
    both = F.array(F.struct(F.col("_s").alias("_ts"), F.lit(STARTS).alias("_kind"), F.col("_r").alias("_delta")),
                   F.struct(F.col("_e").alias("_ts"), F.lit(ENDS).alias("_kind"), (-F.col("_r")).cast(held.schema["_r"].dataType).alias("_delta")))
    return held.select(*k, F.inline(both))


def rate_at_moments(moments: DataFrame, events: DataFrame, keys, name: str = "rate", block: str = "month") -> DataFrame:
    """``(keys, _ts, name)``, one row for each of the ``moments (keys, _ts)``."""
    k = _cols(keys)
    line = events.unionByName(moments.select(*k, "_ts", F.lit(READING).alias("_kind"), F.lit(0).cast(events.schema["_delta"].dataType).alias("_delta")))
    # what happens at one moment is one row: repeated readings and rates combine before the shuffle
    line = line.groupBy(*k, "_ts", "_kind").agg(F.sum("_delta").alias("_delta")).withColumn("_block", F.date_trunc(block, "_ts"))
    kind = line.schema["_delta"].dataType
    within = F.sum("_delta").over(Window.partitionBy(*k, "_block").orderBy("_ts", "_kind").rowsBetween(Window.unboundedPreceding, 0))
    swept = line.withColumn("_within", within.cast(kind))
    # a block's total is its last running sum: read from the same shuffle as the sums
    totals = swept.groupBy(*k, "_block").agg(F.max_by("_within", F.struct("_ts", "_kind")).alias("_d"))
    earlier = F.sum("_d").over(Window.partitionBy(*k).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    before = totals.select(*k, "_block", F.coalesce(earlier.cast(kind), F.lit(0).cast(kind)).alias("_before"))
    found = swept.where(F.col("_kind") == READING).join(before, on=[*k, "_block"])
    return found.select(*k, "_ts", (F.col("_before") + F.col("_within")).cast(kind).alias(name))


def interval_rate(readings: DataFrame, rates: DataFrame, keys, reading_ts: Column, start_col: str, end_col: str,
                  rate_col: str, name: str = "rate", block: str = "month", moments: DataFrame | None = None) -> DataFrame:
    """Readings with the rate summed over the intervals that hold their moment, borders
    included; 0 where none does (NVL(SUM, 0)), also for null keys and moments.  ``keys``
    name the columns on both sides; ``block`` is the unit of time that a key's history is
    split by (any unit of ``date_trunc``).  ``moments (keys, _ts)`` names the moments of all
    readings, and perhaps others, where that is cheaper than reading the readings twice."""
    k = _cols(keys)
    events = rate_events(rates, k, start_col, end_col, rate_col)
    at = readings.withColumn("_ts", reading_ts.cast("timestamp_ntz"))
    asked = at.select(*k, "_ts") if moments is None else moments.select(*k, F.col("_ts").cast("timestamp_ntz").alias("_ts"))
    found = rate_at_moments(asked.dropna(), events, k, name="_found", block=block)
    kind = found.schema["_found"].dataType
    return (at.join(found, on=[*k, "_ts"], how="left")
            .withColumn(name, F.coalesce("_found", F.lit(0).cast(kind))).drop("_ts", "_found"))
