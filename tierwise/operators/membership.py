"""Rows that a join will drop are left out before they move.

An inner join with a filtered side, or a side that only some keys of the other ask for,
shuffles all rows first and drops most of them then.  :func:`keep_members` tests each row
against a map of bits: three of about eight a key, all in one row of 32,768, at most
``MOST_BITS``.  The map is built by Spark row by row and is broadcast; it has 16 MB of bits at
most, 32 MB as read, whatever the input.  It may keep a row without a partner (some three in
a hundred of those), never drop one that has a partner: the join itself still decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PLACES, BITS_PER_KEY, MOST_BITS = 3, 8, 1 << 27
_BITS = 15
_ROW = 1 << _BITS       # bits of one row of the map, as bitmap_construct_agg has them
#: Types whose equal values have equal hashes (a double has two zeros, a collated text many spellings).
_EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType, T.BinaryType)


def _hashable(a: T.DataType, b: T.DataType) -> bool:
    return a == b and (isinstance(a, _EXACT) or a == T.StringType())


def _places(keys: Sequence[str], rows: int) -> tuple[Column, list[Column]]:
    """Row of the map, and the places within it, from slices of one 64-bit hash."""
    h = F.xxhash64(*keys)
    return F.pmod(h, F.lit(rows)).cast("int"), [F.shiftrightunsigned(h, 64 - _BITS * (i + 1)).bitwiseAND(F.lit(_ROW - 1)) for i in range(PLACES)]


def key_map(of: DataFrame, keys: Sequence[str], expected: int | None = None) -> tuple[DataFrame, int]:
    """``(__row, __words)`` and the number of rows.  ``expected`` is the number of keys, if
    known; else the rows of ``of`` are counted."""
    n = of.count() if expected is None else expected
    rows = min(MOST_BITS, max(_ROW, 1 << (BITS_PER_KEY * max(1, n) - 1).bit_length())) // _ROW
    row, places = _places(keys, rows)
    bits = (of.dropna(subset=list(keys)).select(row.alias("__row"), F.explode(F.array(*places)).alias("_place"))
            .groupBy("__row").agg(F.expr("bitmap_construct_agg(_place)").alias("_bits")))
    # four bytes a word, the first byte highest
    words = F.expr(f"transform(sequence(0, {_ROW // 32 - 1}), i -> cast(conv(hex(substring(_bits, 4 * i + 1, 4)), 16, 10) AS bigint))")
    return bits.select("__row", words.alias("__words")), rows


def keep_members(df: DataFrame, keys: Sequence[str], of: DataFrame, of_keys: Sequence[str] | None = None, expected: int | None = None) -> DataFrame:
    """``df`` without rows that have no partner among the ``of_keys`` of ``of`` (a null key has none).

    Exact for what follows as an equality join on all of the keys; columns and repeats stay.
    Keys of different types, or of a type without one hash, are not tested."""
    keys, of_keys = list(keys), list(of_keys or keys)
    tested = [(k, o) for k, o in zip(keys, of_keys, strict=True) if _hashable(df.schema[k].dataType, of.schema[o].dataType)]
    if not tested:
        return df
    names = [f"_k{i}" for i in range(len(tested))]
    words, rows = key_map(of.select(*[F.col(o).alias(n) for n, (_, o) in zip(names, tested)]), names, expected)
    row, places = _places([k for k, _ in tested], rows)
    held = row == F.col("__row")
    for bit in places:
        word = F.element_at("__words", (F.shiftright(bit, 5) + 1).cast("int"))
        shift = (F.lit(24) - F.shiftright(bit, 3).bitwiseAND(F.lit(3)) * 8 + bit.bitwiseAND(F.lit(7))).cast("int")
        held = held & (F.call_function("shiftright", word, shift).bitwiseAND(F.lit(1)) == 1)
    return df.dropna(subset=[k for k, _ in tested]).join(F.broadcast(words), held, "left_semi")
