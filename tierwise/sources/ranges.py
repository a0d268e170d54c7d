"""Balanced read ranges of a source table (SRC-11, SRC-12).

Even strides between the smallest and the largest key give one reader nearly all rows
when keys are skewed.  Here the borders are quantiles of the key, from a frame that has
its distribution (the table's last loaded version, or a narrow read of the key column),
so no range holds more than about twice its share; a key with more rows than that is a
range of its own.  The predicates are plain comparisons that the source can answer from
an index; they are disjoint and complete: each row satisfies exactly one, and NULL keys
belong to the first.
"""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ACCURACY = 100_000


def key_borders(keys: DataFrame, column: str, ranges: int) -> list[tuple[object, bool]]:
    """At most ``ranges - 1`` rising borders, each with whether that key alone fills a
    range (it was several quantiles).  One aggregate; quantiles to 1 in 100,000."""
    if ranges < 1:
        raise ValueError("at least one range")
    if ranges == 1:
        return []
    c = F.col(column)
    low, found = keys.agg(F.min(c), F.percentile_approx(c, [i / ranges for i in range(1, ranges)], ACCURACY)).first()
    times = Counter(found or [])
    return [(v, times[v] > 1) for v in sorted(times) if v > low or times[v] > 1]


def literal(value) -> str:
    """A border as text that SQL databases read alike."""
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, (int, decimal.Decimal)) and not isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return f"{value!r}"
    raise TypeError(f"no ranges over {type(value).__name__} keys")


def range_predicates(column: str, borders: list[tuple[object, bool]]) -> list[str]:
    """One condition for each range between the borders, and one for each key that fills
    a range."""
    if not borders:
        return ["1 = 1"]
    out, since = [], None
    for value, alone in borders:
        at = literal(value)
        out.append(f"{since} AND {column} < {at}" if since else f"{column} < {at} OR {column} IS NULL")
        if alone:
            out.append(f"{column} = {at}")
        since = f"{column} > {at}" if alone else f"{column} >= {at}"
    return [*out, since]


def balanced_predicates(keys: DataFrame, column: str, ranges: int) -> list[str]:
    """Predicates for about ``ranges`` equal reads of a table whose key is distributed as
    in ``keys``.  A number, date or timestamp column."""
    kind = keys.schema[column].dataType
    if not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise TypeError(f"no ranges over a {kind.simpleString()} column")
    return range_predicates(column, key_borders(keys, column, ranges))
