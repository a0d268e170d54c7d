"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint of 64 bits has, per bit, 1 where more than half of the hashes of
its shingles have a 1.  Two fingerprints link at ``max_bits`` or fewer differing
bits.  With 3 bits and two segments of 32, one segment differs by at most one
bit, so the two share a variant of that segment with one position left out.
Every distinct fingerprint is indexed under its 64 variants, equal variants meet
in one bucket, and the whole fingerprints are compared there.

A bucket yields a spanning forest of its links, not all pairs.  A bucket larger
than ``bucket_rows`` is dealt anew by variants of the other segment's halves, and
what is still larger by pairs of blocks, so no task holds an unbounded bucket and
no link is lost.

Defined cases: a null or empty text, or one without words, has fingerprint zero
and links like any other; fewer words than the shingle length make one shingle;
repeated rows have equal results; an empty table gives an empty result; other
columns of the input are not read.  A null id is never a component id unless all
documents of its component have none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import connected_components, fresh, utf8, written

BITS, SEGMENT = 64, 32
EDGE, LATER = 0, 1


def fingerprint_bytes(text: bytes, width: int = 3, seed: int = 42) -> int:
    """Fingerprint of one text (UTF-8); plain form of the contract."""
    words = text.lower().split()            # bytes: only A-Z are lower-cased, only ASCII white space splits
    n = len(words)
    if not n:
        return 0
    if n <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n)) + np.arange(n)
    starts = np.concatenate(([0], ends[:-1] + 1))
    ends, starts = ends[width - 1:].tolist(), starts[:n - width + 1].tolist()
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), 32768):     # a long text in parts, so memory stays flat
        parts = [joined[s:e] for s, e in zip(starts[at:at + 32768], ends[at:at + 32768])]
        hashes = np.frombuffer(b"".join(map(xxhash.xxh64_digest, parts, repeat(seed))), np.uint8).reshape(-1, 8)
        counts += np.unpackbits(hashes, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(starts)).tobytes(), "big")


def _fingerprints(width: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets, _ = utf8(batch.column(1))
            raw = memoryview(data)
            values = [fingerprint_bytes(bytes(raw[s:e]), width, seed) for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            fp = np.array(values, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], ["id", "fp"])
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    """``(id, fp)``, one row per document; ``fp`` is the fingerprint as a signed long."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(_fingerprints(width, seed), "id long, fp long")


def _forest(fps: np.ndarray, max_bits: int) -> tuple[list, list]:
    """Links that span the groups among distinct fingerprints of one bucket."""
    a, b = [], []
    rest = fps
    while len(rest):
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            u = reached.pop()
            near = np.bitwise_count(rest ^ u) <= max_bits
            if near.any():
                got = rest[near]
                a.append(np.full(len(got), u, np.uint64))
                b.append(got)
                reached.extend(got)
                rest = rest[~near]
    return a, b


def _compare(max_bits: int, bucket_rows: int):
    """Buckets arrive in order of their key; a bucket may span several batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps, passing = np.zeros(0, np.int64), np.zeros(0, np.uint64), None

        def out(kind, a, b):
            if not a:
                return
            a, b = np.concatenate(a), np.concatenate(b)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int8)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["kind", "a", "b"])

        def buckets(keys, fps):
            at = np.flatnonzero(np.diff(keys)) + 1
            starts, ends = np.concatenate(([0], at)), np.concatenate((at, [len(keys)]))
            size = ends - starts
            two = starts[size == 2]                  # by far the most frequent: at once
            x, y = fps[two], fps[two + 1]
            near = (np.bitwise_count(x ^ y) <= max_bits) & (x != y)
            a, b = [x[near]], [y[near]]
            for s, e in zip(starts[size > 2].tolist(), ends[size > 2].tolist()):
                if e - s > bucket_rows:
                    yield from out(LATER, [keys[s:e].view(np.uint64)], [fps[s:e]])
                else:
                    p, q = _forest(np.unique(fps[s:e]), max_bits)
                    a += p
                    b += q
            yield from out(EDGE, a, b)

        for batch in batches:
            k = batch.column(0).to_numpy(zero_copy_only=False)
            f = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if passing is not None:                  # a bucket already known as too large passes through
                n = int(np.searchsorted(k, passing, side="right"))
                yield from out(LATER, [k[:n].view(np.uint64)], [f[:n]])
                k, f, passing = k[n:], f[n:], passing if n == len(k) else None
            if not len(k):
                continue
            keys, fps = np.concatenate((keys, k)), np.concatenate((fps, f))
            last = int(np.searchsorted(keys, keys[-1], side="left"))
            if last:
                yield from buckets(keys[:last], fps[:last])
                keys, fps = keys[last:], fps[last:]
            if len(keys) > bucket_rows:
                passing = keys[-1]
                yield from out(LATER, [keys.view(np.uint64)], [fps])
                keys, fps = keys[:0], fps[:0]
        if len(keys):
            yield from buckets(keys, fps)
    return run


def _met(rows: DataFrame, max_bits: int, bucket_rows: int, name: str) -> DataFrame:
    dealt = rows.select("key", "fp").repartition("key").sortWithinPartitions("key", "fp")
    return written(dealt.mapInArrow(_compare(max_bits, bucket_rows), "kind byte, a long, b long"), name)


def links(fps: DataFrame, max_bits: int = 3, bucket_rows: int = 8192) -> DataFrame:
    """``(a, b)``: links between the distinct fingerprints of ``fps(fp)`` that
    span every group of fingerprints reachable by ``max_bits`` or fewer bits."""
    if not 0 <= max_bits <= 3:
        raise ValueError("two segments with one wildcard each serve at most 3 differing bits")
    low = F.expr(f"(1L << {SEGMENT}) - 1")
    i = F.col("i")
    bit = F.expr("~shiftleft(1L, i)")
    kept = F.when(i < SEGMENT, F.col("fp").bitwiseAND(low)).otherwise(F.col("fp").bitwiseAND(F.expr(f"~((1L << {SEGMENT}) - 1)")))
    # the variant's number stands in the segment that the variant leaves out
    tag = F.when(i < SEGMENT, F.expr(f"shiftleft(cast(i AS long), {SEGMENT})")).otherwise(i.cast("long"))
    variants = (fps.select("fp").withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))))
                .select(kept.bitwiseAND(bit).bitwiseOR(tag).alias("key"), "fp"))
    met = _met(variants, max_bits, bucket_rows, "simhash-links")
    edges, later = met.where(F.col("kind") == EDGE).select("a", "b"), met.where(F.col("kind") == LATER)
    if later.isEmpty():
        return edges
    # large buckets: the other segment's halves, one position left out of one half
    j = F.col("j")
    other = F.expr(f"CASE WHEN shiftright(a, {SEGMENT}) BETWEEN 0 AND {SEGMENT - 1} THEN shiftrightunsigned(b, {SEGMENT}) ELSE b & ((1L << {SEGMENT}) - 1) END")
    half = F.expr("CASE WHEN j < 16 THEN other & 65535L ELSE other & 4294901760L END & ~shiftleft(1L, j)")
    finer = (later.select(F.col("a"), F.col("b").alias("fp"), other.alias("other"))
             .withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(SEGMENT - 1))))
             .select(F.xxhash64(F.col("a"), j, half).alias("key"), "fp"))
    met = _met(finer, max_bits, bucket_rows, "simhash-finer")
    edges, later = edges.union(met.where(F.col("kind") == EDGE).select("a", "b")), met.where(F.col("kind") == LATER)
    if later.isEmpty():
        return edges
    # what is still larger: every pair of blocks of the bucket is one small bucket
    later = later.select(F.col("a").alias("key"), F.col("b").alias("fp")).distinct()
    parts = later.groupBy("key").agg(F.ceil(F.count("*") * 4 / F.lit(bucket_rows)).cast("int").alias("n"))
    own = F.expr("cast(pmod(xxhash64(fp), n) AS int)")
    pairs = (later.join(parts, "key").withColumn("own", own)
             .withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
             .select(F.xxhash64("key", F.least("own", "k"), F.greatest("own", "k")).alias("key"), "fp"))
    met = _met(pairs, max_bits, 1 << 40, "simhash-blocks")
    return edges.union(met.where(F.col("kind") == EDGE).select("a", "b"))


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
               max_bits: int = 3, seed: int = 42, bucket_rows: int = 8192) -> DataFrame:
    """``(id, fp, component_id)``, one row per document."""
    rows = written(fingerprints(docs, id_col, text_col, width, seed), "simhash-fp")
    firsts = written(rows.groupBy("fp").agg(F.min("id").alias("first")), "simhash-first")
    found = links(firsts, max_bits, bucket_rows)
    named = (found.join(firsts.toDF("a", "x"), "a").join(firsts.toDF("b", "y"), "b")
             .select(F.col("x").alias("a"), F.col("y").alias("b")).where("a IS NOT NULL AND b IS NOT NULL"))
    comp = connected_components(named, "simhash-cc")
    classes = (firsts.join(comp, firsts["first"] == comp["node"], "left")
               .select("fp", F.coalesce("component", "first").alias("component_id")))
    return rows.join(classes, "fp", "left").select("id", "fp", "component_id")


def simhash_near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the near-duplicates: the document with the smallest id of
    each component stays, with all its columns; a document without id stays."""
    of, = fresh(docs, "__gone_id")
    gone = components(docs, id_col, text_col, **options).where("id <> component_id").select("id").distinct().toDF(of)
    return docs.join(gone, F.col(id_col).cast("long") == F.col(of), "left_anti")
