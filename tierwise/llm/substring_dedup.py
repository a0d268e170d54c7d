"""Exact substring dedup: every byte covered by a ``length``-byte string that also
starts earlier (smaller document id, or same document and earlier start) goes.

Windows of ``length`` bytes are the suffixes to sort, cut at that depth.  Each
window has an anchor, the position of the smallest hash among its ``GRAM``-byte
grams (leftmost at ties).  Equal windows have equal anchors at equal places, so

1. anchors are counted over the corpus (a grouped sum); windows whose anchor is
   unique cannot repeat;
2. every run of windows with a repeated anchor, with its bytes, goes to the suffix
   bucket of that anchor; copies within a batch are settled before the shuffle;
3. in a bucket, equal runs collapse to the first; the distinct ones of one block of
   buckets at a time are sorted by a difference cover: positions
   congruent to 0, 1 or 3 modulo 7 are the sample, whose ranks come from doubling;
   two windows agree if their first seven and last nine bytes do and their sample
   positions at one common shift (there always is one below seven) have the same
   rank.  A block holds a bounded number of bytes, so memory is bounded;
4. the covered spans return to their documents, whose bytes are cut.

A bucket beyond ``bucket_bytes`` (a passage that very many documents share, with
other bytes around it) is dealt by single windows instead: a grouped minimum per
window, which combines before the shuffle.  No bucket is capped or sampled.

Defined cases: a null text is empty; texts below ``length`` bytes lose nothing;
rows that repeat an id are the same document and do not cover each other; a null
id comes before all others; an empty table gives an empty result; other columns
are not read.  Strings are judged on the input, and never cross documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import member_words, row_slices, split_by_members, utf8, written

GRAM = 24
#: A perfect difference cover: every difference modulo PERIOD is one of two members.
PERIOD, COVER = 7, (0, 1, 3)
NO_ID = -(1 << 63)
PART_BYTES = 8 << 20
SPAN, LATER = 0, 1
_BASE = 0x9E3779B97F4A7C15
_POWERS: list = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        both = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(max(n, 1 << 21), b, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _POWERS[:] = both
    return _POWERS[0], _POWERS[1]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(32))


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each position on; it depends on them alone."""
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, inverse = _powers(len(data))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data + np.uint64(1)) * power[:len(data)], dtype=np.uint64)))
    return _mixed((sums[size:] - sums[:-size]) * inverse[:n])


def anchored_runs(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """``(row, first window, number of windows, anchor key)`` of the runs of windows
    that have one anchor, for rows at ``offsets`` (from 0) of ``data``."""
    h = gram_hashes(data, GRAM)
    width = length - GRAM + 1
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, np.zeros(0, np.uint64)
    at = np.arange(len(h), dtype=np.uint64)
    low = (h & np.uint64(0xFFFFFFFF00000000)) | at
    size = 1
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < width:
        low = np.minimum(low[:len(low) - (width - size)], low[width - size:])
    starts = offsets[:-1]
    room = np.maximum(np.diff(offsets) - length + 1, 0)
    window = np.arange(int(room.sum())) + np.repeat(starts - np.cumsum(room) + room, room)
    if not len(window):
        return none, none, none, np.zeros(0, np.uint64)
    anchor = (low[window] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # one anchor never serves two rows, as its gram lies inside the row
    first = np.flatnonzero(np.diff(anchor, prepend=-1))
    count = np.diff(np.append(first, len(anchor)))
    row = np.searchsorted(offsets, window[first], side="right") - 1
    return row, window[first], count, h[anchor[first]]


def _joined(batch: pa.RecordBatch, column: int, size: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets, _ = utf8(batch.column(column))
    for i, j in row_slices(offsets, size):
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]


def _anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for i, _, data, offsets in _joined(batch, 1):
                row, _, _, key = anchored_runs(data, offsets, length)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(row + i)), pa.array(key.view(np.int64))], ["id", "key"])
    return run


def _merged(start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Spans ``(from, to)`` that windows at sorted ``start`` cover."""
    new = np.flatnonzero(np.diff(start, prepend=start[0] - length - 1) > length)
    return start[new], start[np.append(new[1:], len(start)) - 1] + length


_SCHEMA = "kind byte, key long, id long, first long, n long, bytes binary"


def _batch(kind, key, ids, first, n, raw=None) -> pa.RecordBatch:
    m = len(ids)
    cols = [pa.array(np.full(m, kind, np.int8)), pa.array(key, pa.int64()), pa.array(ids, pa.int64()), pa.array(first, pa.int64()), pa.array(n, pa.int64()),
            pa.array(raw, pa.binary()) if raw is not None else pa.nulls(m, pa.binary())]
    return pa.RecordBatch.from_arrays(cols, ["kind", "key", "id", "first", "n", "bytes"])


def _contexts(length: int):
    """Runs of windows with a repeated anchor: their bytes to the anchor's bucket.
    Of equal runs in a part of a batch the first is sent and the others are covered
    (kind ``SPAN``, dealt by a key of their own)."""
    def out(seen: dict, spans: list) -> Iterator[pa.RecordBatch]:
        sent = list(seen.values())
        for a in range(0, len(sent), 8192):
            d, f, n, k, text = zip(*sent[a:a + 8192])
            yield _batch(LATER, k, d, f, n, text)
        for a in range(0, len(spans), 65536):
            d, f, n = zip(*spans[a:a + 65536])
            yield _batch(SPAN, np.array(d) ^ np.array(f), d, f, n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            lists = batch.column(2)
            ends = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
            repeated = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            seen: dict[bytes, tuple] = {}
            spans: list = []
            size = 0
            for i, j, data, offsets in _joined(batch, 1):
                size += len(data)
                if size > PART_BYTES:
                    yield from out(seen, spans)
                    seen, spans, size = {}, [], len(data)
                row, first, count, key = anchored_runs(data, offsets, length)
                per = np.repeat(np.arange(i, j), np.diff(ends[i:j + 1])).astype(np.uint64)
                salt = np.uint64(_BASE)
                good = np.isin(_mixed(key ^ ((row + i).astype(np.uint64) * salt)), _mixed(repeated[ends[i]:ends[j]] ^ (per * salt)))
                raw = data.tobytes()
                for r, f, n, k in zip(row[good].tolist(), first[good].tolist(), count[good].tolist(), key[good].view(np.int64).tolist()):
                    text = raw[f:f + n - 1 + length]
                    mark = blake2b(text, digest_size=16).digest()
                    mine = (int(ids[r + i]), f - int(offsets[r]), n, k, text)
                    had = seen.get(mark)
                    if had is None or mine[:2] < had[:2]:
                        seen[mark], mine = mine, had
                    if mine is not None and mine[:2] != seen[mark][:2]:
                        spans.append(mine[:3])
            yield from out(seen, spans)
    return run


def cover_repeats(pool: np.ndarray, windows: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Which windows (positions in ``pool``) equal one of smaller ``order``.

    Difference-cover sorting to a depth of ``length`` bytes; ranks are those of
    the sorted sample."""
    blocks = length // PERIOD - 1                          # at 100 bytes: 13 periods, 91 bytes,
    depth = blocks * PERIOD                                # and the last 9 as two overlapping numbers
    text = np.concatenate((pool, np.zeros(length + 2 * PERIOD, np.uint8))).astype(np.uint64)

    heads = np.zeros(len(text) - PERIOD + 1, np.uint64)    # PERIOD bytes, big-endian: numbers sort as the bytes do
    for k in range(PERIOD):
        heads = (heads << np.uint64(8)) | text[k:len(text) - PERIOD + 1 + k]

    def ranked(x: np.ndarray) -> np.ndarray:
        return np.unique(x, return_inverse=True)[1].reshape(x.shape).astype(np.int64)

    def pair(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return ranked(x * (int(y.max()) + 1 if y.size else 1) + y)

    # ranks of the sample, a row for each residue of the cover; a step right is one period
    q = (len(pool) + PERIOD - 1) // PERIOD + 1
    where = np.minimum(np.array(COVER)[:, None] + PERIOD * np.arange(q)[None, :], len(heads) - 1)
    ranks, size = {1: ranked(heads[where])}, 1

    def shifted(x: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros_like(x)
        out[:, :x.shape[1] - by] = x[:, by:]
        return out
    while size * 2 <= blocks:
        ranks[2 * size] = pair(ranks[size], shifted(ranks[size], size))
        size *= 2
    sample, done = ranks[size], size
    while done < blocks:                                   # 13 = 8 + 4 + 1 periods
        size = max(s for s in ranks if s <= blocks - done)
        sample = pair(sample, shifted(ranks[size], done))
        done += size
    # first and last bytes of each window
    ends = pair(ranked(heads[windows]), ranked(heads[windows + depth]))
    ends = pair(ends, ranked(heads[windows + length - PERIOD]))
    by_order = np.argsort(order, kind="stable")
    windows, ends, order = windows[by_order], ends[by_order], order[by_order]
    covered = np.zeros(len(windows), bool)
    line_of = {r: k for k, r in enumerate(COVER)}
    for shift in range(PERIOD):
        at = windows + shift
        residue = at % PERIOD
        for_shift = np.flatnonzero(np.isin(residue, COVER))
        line = np.array([line_of.get(r, 0) for r in range(PERIOD)])[residue[for_shift]]
        rank = sample[line, at[for_shift] // PERIOD]
        key = ends[for_shift] * (int(sample.max()) + 1) + rank
        ranking = np.argsort(key, kind="stable")           # of equal keys the earliest comes first
        key, member = key[ranking], for_shift[ranking]
        first = np.flatnonzero(np.diff(key, prepend=key[0] - 1 if len(key) else 0))
        leader = np.repeat(order[member[first]], np.diff(np.append(first, len(key))))
        covered[member[order[member] > leader]] = True
    out = np.zeros(len(covered), bool)
    out[by_order] = covered
    return out


def _buckets(length: int, block_bytes: int, bucket_bytes: int):
    """Buckets come in order of their keys; several make a block.  Yields covered
    spans, and the runs of buckets beyond ``bucket_bytes`` as they came."""
    def block(rows: list) -> Iterator[pa.RecordBatch]:
        rows = [r for group in rows for r in group]
        if len(rows) < 2:
            return
        ids, first, n, raw = zip(*rows)
        ids, first, n = np.array(ids, np.int64), np.array(first, np.int64), np.array(n, np.int64)
        base = np.concatenate(([0], np.cumsum([len(x) for x in raw])))[:-1]
        pool = np.frombuffer(b"".join(raw), np.uint8)
        owner = np.repeat(np.arange(len(rows)), n)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        start = first[owner] + step
        place = np.lexsort((start, ids[owner]))
        order = np.zeros(len(place), np.int64)
        changed = (np.diff(ids[owner][place], prepend=0) != 0) | (np.diff(start[place], prepend=0) != 0)
        order[place] = np.cumsum(changed)                  # equal for the same place in the same document
        covered = cover_repeats(pool, base[owner] + step, order, length)
        if not covered.any():
            return
        # runs of covered windows of one run
        k = np.flatnonzero(covered)
        new = np.flatnonzero((np.diff(owner[k], prepend=-1) != 0) | (np.diff(k, prepend=-2) != 1))
        last = np.append(new[1:], len(k)) - 1
        a = k[new]
        yield _batch(SPAN, np.zeros(len(a), np.int64), ids[owner[a]], start[a], k[last] - a + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, held, key, large = [], 0, None, False
        runs: dict[bytes, tuple] = {}           # of the bucket read: each distinct run once, its first place
        size = 0

        def later():
            return _batch(LATER, [key] * len(runs), *zip(*[(d, f, n) for d, f, n, _ in runs.values()]), list(runs))

        def ended():
            nonlocal groups, held
            if large:
                yield later()
            elif len(runs) > 1:
                groups.append(list(runs.values()))
                held += size
                if held > block_bytes:
                    yield from block(groups)
                    groups, held = [], 0

        for batch in batches:
            kinds = batch.column(0).to_numpy(zero_copy_only=False)
            span = np.flatnonzero(kinds == SPAN)
            if len(span):
                yield batch.take(pa.array(span))
            rows = batch.take(pa.array(np.flatnonzero(kinds == LATER)))
            equal: list = []
            for k, d, f, n, text in zip(*(rows.column(c).to_pylist() for c in range(1, 6))):
                if k != key:
                    if runs:
                        yield from ended()
                    key, runs, size, large = k, {}, 0, False
                had = runs.get(text)
                if had is not None:             # places come in order, so this one is later or the same
                    if (d, f) != had[:2]:
                        equal.append((d, f, n))
                    continue
                runs[text] = (d, f, n, text)
                size += len(text)
                if size > bucket_bytes:
                    large = True
                    yield later()
                    runs, size = {}, 0
            if equal:
                d, f, n = zip(*equal)
                yield _batch(SPAN, np.zeros(len(d), np.int64), d, f, n)
        if runs:
            yield from ended()
        yield from block(groups)
    return run


def _windows(length: int):
    """Every window of the runs, by the digest of its bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, f, n, text in zip(*(batch.column(c).to_pylist() for c in range(4))):
                for a in range(0, n, 65536):
                    m = min(n - a, 65536)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([blake2b(text[a + s:a + s + length], digest_size=16).digest() for s in range(m)], pa.binary()),
                         pa.array(np.full(m, d)), pa.array(np.arange(f + a, f + a + m))], ["window", "id", "start"])
    return run


def _spans_of(docs: DataFrame, length: int, block_bytes: int, bucket_bytes: int) -> DataFrame:
    """``(id, first, n)``: runs of windows that start earlier elsewhere."""
    anchors = docs.mapInArrow(_anchors(length), "id long, key long")
    # written, so that both sides of the join are shuffled and Spark can split a frequent anchor
    repeated = written(anchors.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "substring-repeated")
    wanted = written(anchors.join(repeated, "key").groupBy("id").agg(F.collect_set("key").alias("keys")), "substring-anchors")
    holders, _ = split_by_members(docs, "id", member_words(wanted.select("id")))
    runs = holders.join(wanted, "id").select("id", "text", "keys").mapInArrow(_contexts(length), _SCHEMA)
    sorted_buckets = runs.repartition("key").sortWithinPartitions("key", "id", "first")
    found = written(sorted_buckets.mapInArrow(_buckets(length, block_bytes, bucket_bytes), _SCHEMA), "substring-spans")
    spans = found.where(F.col("kind") == SPAN).select("id", "first", "n")
    large = found.where(F.col("kind") == LATER).select("id", "first", "n", "bytes")
    if not large.isEmpty():
        windows = written(large.mapInArrow(_windows(length), "window binary, id long, start long"), "substring-windows")
        leader = windows.groupBy("window").agg(F.min(F.struct("id", "start")).alias("leader"))
        later = windows.join(leader, "window").where(F.struct("id", "start") > F.col("leader"))
        spans = spans.union(later.select("id", F.col("start").alias("first"), F.lit(1).cast("long").alias("n")))
    return spans


def _cut(length: int):
    """Bytes left of each text, and what was cut."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets, _ = utf8(batch.column(1))
            raw = memoryview(data)
            rows = []
            for i, (first, n) in enumerate(zip(batch.column(2), batch.column(3))):
                text = bytes(raw[offsets[i]:offsets[i + 1]])
                kept, removed, spans, at = [], 0, 0, 0
                if first.is_valid and len(first):
                    first, n = np.array(first.values), np.array(n.values)
                    s, e = first, first + n - 1 + length
                    order = np.argsort(s, kind="stable")
                    s, e = s[order], np.maximum.accumulate(e[order])
                    new = np.flatnonzero(np.concatenate(([True], s[1:] > e[:-1])))
                    for a, b in zip(s[new].tolist(), e[np.append(new[1:], len(s)) - 1].tolist()):
                        b = min(b, len(text))
                        kept.append(text[at:a])
                        removed, spans, at = removed + b - a, spans + 1, b
                kept.append(text[at:])
                left = b"".join(kept)
                rows.append((len(text), removed, spans, sha256(left).hexdigest(), left))
            cols = list(zip(*rows)) or [[]] * 5
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(cols, types)]],
                                             ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
    return run


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100,
                    block_bytes: int = 1 << 20, bucket_bytes: int = 4 << 20) -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept_sha256, kept)``, one row per document;
    ``kept`` are the bytes left."""
    if length < 2 * GRAM:
        raise ValueError("windows need to be at least twice as long as the grams")
    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_col).cast("string").alias("text"))
    spans = _spans_of(src, length, block_bytes, bucket_bytes)
    each = written(spans.groupBy("id").agg(F.collect_list(F.struct("first", "n")).alias("runs")).select(F.col("id"), F.col("runs.first").alias("first"), F.col("runs.n").alias("n")), "substring-runs")
    some, none = split_by_members(src, "id", member_words(each.select("id")))
    nothing = F.lit(None).cast("array<long>")
    rows = some.join(each, "id", "left").select("id", "text", "first", "n").union(none.select("id", "text", nothing, nothing))
    out = rows.mapInArrow(_cut(length), "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out.withColumn("id", F.when(F.col("id") != NO_ID, F.col("id")))
