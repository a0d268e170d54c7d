"""Mixing sources to target weights by systematic sampling.

Every source gets a target in words; a document's expected copies are its source's
target over its source's size, the same for all documents of a source.  Within a
source the documents are put in order of size (ties by a hash of the id), the
expected copies are prefix-summed, one random offset is added and a document is
emitted once for each integer boundary that its share of the sum crosses.  Neighbours
in that order have nearly the same size, so the words taken differ from the target by
about the size of one long document, and no document is emitted more often than the
expected copies rounded up.

Targets share all words by weight and stop at ``max_copies`` times the source's size;
the excess is shared again among the others.  With the level ``t`` of words per unit of
weight, the sum of ``min(t * weight, cap)`` is concave and piecewise linear, so Newton's
steps from below reach the level after finitely many, each one aggregate over the
table of sources.

Scale: texts are read once and counted; what is sorted and shuffled is one short row a
document.  The order comes from a range partitioning by (source, size, hash, id), which
splits a hot source, a hot size and copies alike; equal rows collapse before it and are
dealt out again after it.  Each task counts along its range and the counts of
(source, task) are prefix-summed, so no source is held by one task.  All steps are
integers: reruns agree whatever the partitioning.

Defined cases: a null text has no words, and a document without words is emitted as its
place says, but takes none; a source without words has the target 0 and emits nothing;
a null source is a source of its own, the last one; null and repeated ids are rows of
their own; rows with the same id, size and source are interchangeable; an empty table
gives an empty result; other columns are not read by :func:`mix_plan` and are kept by
:func:`mix_documents`.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierwise.llm.common import columns_of, fresh, row_slices, utf8, written

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
WHOLE = "decimal(38,0)"
#: Equal rows that one step of the expansion turns back into rows.
AT_ONCE = 4096


def words_in(data: np.ndarray, offsets: np.ndarray, max_bytes: int = 8 << 20) -> np.ndarray:
    """Number of words (runs without ASCII white space) of each text."""
    out = np.zeros(len(offsets) - 1, np.int64)
    for i, j in row_slices(offsets, max_bytes):
        lo, hi = offsets[i], offsets[j]
        if lo == hi:
            continue
        ink = ~SPACE[data[lo:hi]]
        first = ink.copy()
        first[1:] &= ~ink[:-1]
        edges = offsets[i:j] - lo
        at = edges[edges < hi - lo]
        first[at] = ink[at]                          # a text starts anew
        run = np.concatenate([[0], np.cumsum(first)])
        out[i:j] = np.diff(run[offsets[i:j + 1] - lo])
    return out


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets, _ = utf8(batch.column(batch.num_columns - 1))
        yield pa.RecordBatch.from_arrays(batch.columns[:-1] + [pa.array(words_in(data, offsets))],
                                         batch.schema.names[:-1] + ["size"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a range in order, with the number of rows of the same group before
    each one in this task (columns: grp, ..., m)."""
    part, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        m = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
        code = batch.column(0).dictionary_encode()
        at = code.indices.to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        before = np.cumsum(m) - m
        nth = before - np.repeat(before[starts], np.diff(np.append(starts, n)))
        if code.dictionary[at[0]].as_py() == last:
            nth[:starts[1] if len(starts) > 1 else n] += seen
        last, seen = code.dictionary[at[-1]].as_py(), int(nth[-1] + m[-1])
        yield pa.RecordBatch.from_arrays(batch.columns + [pa.array(nth), pa.array(np.full(n, part, np.int32))],
                                         batch.schema.names + ["nth", "part"])


def ranked(rows: DataFrame, order: Sequence[str], name: str) -> tuple[DataFrame, DataFrame]:
    """Ranks of rows ``(grp string, ..., m long)`` in ``order`` within their group: the
    rows with ``nth`` and ``part``, and ``(grp, part, before)``; a row's rank is
    ``before + nth`` and it stands for the ``m`` ranks from there on."""
    by = ["grp", *order]
    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    out = written(dealt.mapInArrow(_counted, f"{schema}, nth long, part int"), name)
    each = out.groupBy("grp", "part").agg(F.sum("m").alias("n"))
    # a window of one row a task, not a document
    before = F.sum("n").over(Window.partitionBy("grp").orderBy("part")) - F.col("n")
    return out, each.select("grp", "part", before.alias("before"))


def source_targets(sizes: DataFrame, weights: Sequence[int], max_copies: int) -> DataFrame:
    """``sizes (grp, source_size)`` with ``num, den`` (expected copies of a document as a
    fraction) and ``target`` in words."""
    # the k-th source in order has the k-th weight, repeating
    rows, before = ranked(sizes.select("grp", "source_size").withColumn("one", F.lit("")).select(
        F.col("one").alias("grp"), F.col("grp").alias("name"), "source_size", F.lit(1).cast("long").alias("m")), ["name"], "mix-sources")
    place = (F.col("before") + F.col("nth")) % len(weights)
    weight = F.element_at(F.array(*[F.lit(int(w)).cast("long") for w in weights]), (place + 1).cast("int"))
    s = written(rows.join(before, ["grp", "part"]).select(F.col("name").alias("grp"), "source_size", weight.alias("weight")), "mix-weights")
    size, w = F.col("source_size").cast(WHOLE), F.col("weight").cast(WHOLE)
    total = int(s.agg(F.sum(size)).first()[0] or 0)
    num, den, capped = 0, 1, None
    while total:
        # the cap of a source lies below the level num / den
        full = F.lit(False) if capped is None else size * F.lit(max_copies * den).cast(WHOLE) <= w * F.lit(num).cast(WHOLE)
        row = s.agg(F.count_if(full), F.sum(F.when(full, size)), F.sum(F.when(~full, w))).first()
        if row[0] == capped or not row[2]:
            break
        capped, num, den = (row[0], total, int(row[2])) if capped is None else (row[0], total - max_copies * int(row[1] or 0), int(row[2]))
    full = size * F.lit(max_copies * den).cast(WHOLE) <= w * F.lit(num).cast(WHOLE)
    level = (F.col("weight") * F.lit(num)).cast("double") / F.lit(den).cast("double")
    return s.select("grp", "source_size",
                    F.when(full, F.lit(max_copies).cast(WHOLE)).otherwise((w * F.lit(num).cast(WHOLE)).cast(WHOLE)).alias("num"),
                    F.when(full, F.lit(1).cast(WHOLE)).otherwise((size * F.lit(den).cast(WHOLE)).cast(WHOLE)).alias("den"),
                    F.when(full, (F.col("source_size") * max_copies).cast("double")).otherwise(level).alias("target"))


def text_number(text: Column, digits: int) -> Column:
    """The first hex digits of a text's MD5 as a number."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("long")


def _copies(digest: DataFrame, weights: Sequence[int], max_copies: int, seed: int, name: str) -> DataFrame:
    """``digest (grp, size, tie, id, m)`` with ``source_size, target, copies``, equal rows
    dealt out again."""
    sizes = digest.groupBy("grp").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"))
    targets = source_targets(sizes, weights, max_copies)
    rows, before = ranked(digest, ["size", "tie", "id"], f"{name}-ranks")
    # the random offset of a source, a share of the denominator in 2**32 steps
    h = text_number(F.concat(F.lit(f"{seed}:"), F.col("grp")), 8).cast("decimal(10,0)")
    steps, span = (h * F.col("den").cast("decimal(28,0)")).cast(WHOLE), F.lit(1 << 32).cast("decimal(10,0)")
    shift = (steps - steps % span) / span
    small = before.join(targets, "grp").select("grp", "part", "before", "source_size", "target", "num", "den", shift.cast(WHOLE).alias("shift"))
    joined = rows.join(small, ["grp", "part"]).withColumn("rank", F.col("before") + F.col("nth"))
    for step, most in (("block", AT_ONCE), ("one", 1)):
        # ``m`` equal rows: blocks of them first, so that no array grows with their number
        joined = (joined.withColumn(step, F.explode(F.expr(f"sequence(0L, cast((m - 1) div {most} AS bigint))")))
                  .withColumn("rank", F.col("rank") + F.col(step) * most)
                  .withColumn("m", F.least(F.lit(most).cast("long"), F.col("m") - F.col(step) * most)))
    upto = "cast((cast({} AS decimal(19,0)) * cast(num AS decimal(19,0)) + shift) AS decimal(38,0)) div den"
    copies = F.when(F.col("source_size") > 0, F.expr(f"({upto.format('rank + 1')}) - ({upto.format('rank')})")).otherwise(F.lit(0))
    return joined.select("id", "size", "source_size", "target", copies.cast("long").alias("copies"))


def _group(source: Column) -> Column:
    """A name for each source that sorts by code point, null last."""
    return F.when(source.isNull(), F.lit("b")).otherwise(F.concat(F.lit("a"), source.cast("string")))


def mix_plan(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_copies: int = 3, seed: int = 42,
             id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: ``id, size, source_size, target, copies, taken`` (words).
    ``weights`` are dealt to the sources by code point, repeating."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), _group(F.col(source_col)).alias("grp"), F.col(text_col).cast("string").alias("text"))
    sized = src.mapInArrow(_sizes, "id long, grp string, size long")
    tie = F.coalesce(text_number(F.col("id").cast("string"), 15), F.lit(-1))
    # equal rows collapse on the way
    digest = written(sized.groupBy("grp", "size", "id").agg(F.count("*").alias("m")).select("grp", "size", tie.alias("tie"), "id", "m"), "mix-sizes")
    return _copies(digest, weights, max_copies, seed, "mix").withColumn("taken", F.col("copies") * F.col("size"))


def mix_documents(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_copies: int = 3, seed: int = 42,
                  id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as the plan emits it."""
    row, copy = fresh(docs, "__row", "__copy")
    kept = written(docs.withColumn(row, F.monotonically_increasing_id()), "mix-rows")
    src = kept.select(F.col(row).alias("id"), F.col(id_col).cast("string").alias("doc"), _group(F.col(source_col)).alias("grp"), F.col(text_col).cast("string").alias("text"))
    sized = src.mapInArrow(_sizes, "id long, doc string, grp string, size long")
    digest = written(sized.select("grp", "size", F.coalesce(text_number(F.col("doc"), 15), F.lit(-1)).alias("tie"), "id", F.lit(1).cast("long").alias("m")), "mix-sizes")
    plan = _copies(digest, weights, max_copies, seed, "mix").where("copies > 0").select(F.col("id").alias(row), F.col("copies").alias(copy))
    out = kept.join(plan, row)
    return out.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copy)))).select(columns_of(docs))
