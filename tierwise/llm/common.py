"""Helpers shared by the operators: written tables, Arrow access, components."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.session import scratch_path

BATCH_BYTES = "8m"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def small_batches(spark: SparkSession) -> None:
    """Bound the batches that Python workers get by bytes of text, so a worker's
    memory does not depend on how long the documents are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; Python workers on this machine find the package where the driver
    found it (a cluster gets it with ``--py-files``)."""
    small_batches(spark)
    env = spark.sparkContext.environment
    if not any(ROOT in e.get("PYTHONPATH", "").split(os.pathsep) for e in (env, os.environ)):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, env.get("PYTHONPATH", "")]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    Cuts the lineage: what was computed survives lost executors and is computed
    once however often the result is used.
    """
    spark = df.sparkSession
    small_batches(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """``(bytes, offsets, base)`` of a string or binary column without a copy;
    row ``i`` is ``bytes[offsets[i]:offsets[i + 1]]``, null rows are empty."""
    bufs = column.buffers()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(bufs[1], np.int64 if wide else np.int32) if bufs[1] else np.zeros(1, np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if len(column) == 0:
        offsets = np.zeros(1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] else np.zeros(0, np.uint8)
    return data, offsets, int(offsets[0])


def row_slices(offsets: np.ndarray, max_bytes: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose text has at most ``max_bytes`` (one row may have more)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + max_bytes, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def spread(offsets: np.ndarray) -> np.ndarray:
    """Row number of each element, for offsets that start at 0."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def sampled(share: float, *columns: str):
    """Condition that holds for about ``share`` of the values: the whole 64-bit hash
    is compared, so no share that a table can need is rounded to none."""
    if share >= 1:
        return F.lit(True)
    return F.xxhash64(*columns) < F.lit(int(share * 2**64) - 2**63)


#: Places of a membership filter; its table has at most ``FILTER_PLACES / 64`` rows.
FILTER_PLACES = 1 << 24


def member_words(ids: DataFrame) -> DataFrame:
    """Membership filter of the ids (one long column): a fixed number of hashed
    places as words of 64 bits.  Its size does not grow with the input, so it may
    be broadcast; it may say yes for an id that is not there, never no for one that is."""
    place = F.pmod(F.xxhash64(F.col(ids.columns[0])), F.lit(FILTER_PLACES))
    return (ids.select(F.floor(place / 64).alias("__word"), (place % 64).cast("int").alias("bit"))
            .groupBy("__word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("__bits")))


def fresh(docs: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``docs`` has them in any case."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def columns_of(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def split_by_members(docs: DataFrame, id_col: str, words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` whose id may be a member, and those whose id is none; no shuffle."""
    place, word, bits = fresh(docs, "__place", "__word", "__bits")
    tested = (docs.withColumn(place, F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(FILTER_PLACES)))
              .withColumn(word, F.floor(F.col(place) / 64)).join(F.broadcast(words.toDF(word, bits)), word, "left"))
    maybe = F.expr(f"coalesce(shiftright({bits}, cast({place} % 64 AS int)) & 1L, 0L) = 1L")
    return tested.where(maybe).select(columns_of(docs)), tested.where(~maybe).select(columns_of(docs))


def connected_components(edges: DataFrame, name: str = "cc", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` of the graph with ``edges(a, b)``; ``component`` is the
    smallest node reachable.  The smallest nodes themselves are absent.

    Alternating large-star and small-star rounds (Kiveris et al., 2014): every
    round is a grouped minimum, which combines before the shuffle, and an
    equality join, which Spark splits for hubs.  No group is collected and no
    link reaches the driver; each round is a written table.
    """
    def norm(df: DataFrame) -> DataFrame:
        return df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def state(df: DataFrame) -> tuple:
        return tuple(df.select(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b") % 1000003)).first())

    e = written(norm(edges.select("a", "b")), name)
    was = state(e)
    for _ in range(max_rounds):
        if was[0] == 0:
            break
        both = e.union(e.select("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = written(norm(large), name)
        # every row of ``large`` points from the larger to the smaller node
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("x"), "m").union(small.select(F.col("a").alias("x"), "m"))
        e = written(norm(small.select(F.col("x").alias("a"), F.col("m").alias("b"))), name)
        now = state(e)
        if now == was:
            break
        was = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
