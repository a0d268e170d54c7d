"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts and benchmark items are normalized (ASCII case folded, everything but
letters, digits and non-ASCII bytes to single spaces).  An item is cut into
overlapping passages of two sizes: ``passage_bytes`` (the whole item if it is not
longer), and ``quote_bytes`` starting every fifth of that, so a verbatim quote of
``quote_bytes * 6 / 5`` bytes holds a whole passage wherever it begins.  A passage of ``m`` bytes that occurs with at most ``k``
edits shares at least ``m - q + 1 - k * q`` q-grams with its place, all on
diagonals at most ``k`` apart.  Shared q-grams are counted in diagonal bands that
overlap by half, so one band holds them all, first by item and then by passage;
bands that reach the bound are kept and verified by banded alignment.

The documents are scanned once for each block of distinct item texts (``index_bytes``
of text; a longer single text is a block of its own size).  One block at a time is
broadcast, and with several its findings are written before the next, so memory is
bounded whatever the size of the benchmark; there is no cap on hits.

Defined cases: a null or empty text or item matches nothing; an item with fewer
than ``least_bytes`` normalized bytes matches exactly, from word border to word
border; of an item of up to ``quote_bytes`` only the whole (within the edit budget)
counts;
repeated rows have equal results; an empty table gives an empty result; positions
are code points of the original text, the end exclusive; columns other than those
named are only passed through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import row_slices, small_batches, utf8, written
from tierwise.session import scratch_path

Q = 8
SEPARATOR = 0x0A
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = [*range(48, 58), *range(97, 123), *range(128, 256)]
_FOLD[65:91] = np.arange(97, 123)
_MULTIPLIER, _FILTER_BITS = np.uint64(0x9E3779B97F4A7C15), 22


def normalize(data: np.ndarray, ends: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Normalized bytes and the place of each in ``data``.  Each row end becomes a separator."""
    out = _FOLD[data]
    if ends is not None:
        out[ends] = SEPARATOR
    space = out == 0x20
    keep = ~space
    keep[1:] |= ~space[:-1]         # the first space of a run stays
    at = np.flatnonzero(keep)
    return out[at], at


def grams(data: np.ndarray) -> np.ndarray:
    """The ``Q`` bytes from each position on as one number."""
    if len(data) < Q:
        return np.zeros(0, np.uint64)
    x = data.astype(np.uint64)
    for width in (1, 2, 4):
        x = x[:-width] | (x[width:] << np.uint64(8 * width))
    return x


class Index:
    """Passages of benchmark items and the items' q-grams."""

    def __init__(self, items: list[tuple[int, str]], passage_bytes: int = 200, quote_bytes: int = 100, error: float = 0.1, least_bytes: int = 40):
        self.exact: dict[int, dict[bytes, list[int]]] = {}      # short items by length
        parts, names = [], []
        for item, text in items:
            norm, _ = normalize(np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8))
            norm = norm.tobytes().strip()
            if len(norm) >= least_bytes:
                parts.append(norm)
                names.append(item)
            elif norm:
                self.exact.setdefault(len(norm), {}).setdefault(norm, []).append(item)
        self.heads = {m: np.unique([int.from_bytes(t[:Q], "little") for t in of]).astype(np.uint64) for m, of in self.exact.items()}
        self.pool = np.frombuffer(b"".join(parts), np.uint8)
        self.base = np.concatenate(([0], np.cumsum([len(x) for x in parts]))).astype(np.int64)
        size = np.diff(self.base)
        starts, lengths, owners, self.sizes = [], [], [], []
        for width, step, whole in ((passage_bytes, max(1, passage_bytes // 2), True), (quote_bytes, max(1, quote_bytes // 5), False)):
            before = len(starts)
            for i, m in enumerate(size.tolist()):
                if m > width:
                    at = [*range(0, m - width, step), m - width]
                else:
                    at = [0] if whole else []
                starts += [int(self.base[i]) + x for x in at]
                lengths += [min(m, width)] * len(at)
                owners += [i] * len(at)
            self.sizes.append((width, before, len(starts)))
        self.start, self.length = np.array(starts, np.int64), np.array(lengths, np.int64)
        owner = np.array(owners, np.int64)
        self.item = np.array(names, np.int64)[owner]
        self.budget = np.minimum((error * self.length).astype(np.int64), (self.length - Q) // Q)
        self.least = self.length - Q + 1 - self.budget * Q
        self.item_budget, self.item_least = np.zeros(len(parts), np.int64), np.full(len(parts), 1 << 40)
        np.maximum.at(self.item_budget, owner, self.budget)
        np.minimum.at(self.item_least, owner, self.least)
        value = grams(self.pool)
        inside = np.ones(len(value), bool)
        for e in self.base[1:-1].tolist():          # grams across two items
            inside[max(0, e - Q + 1):e] = False
        place = np.flatnonzero(inside).astype(np.int32)
        value = value[place]
        order = np.argsort(value, kind="stable")
        self.gram = place[order]
        self.values, self.first = np.unique(value[order], return_index=True)
        self.first = np.append(self.first, len(value))
        self.seen = np.zeros(1 << _FILTER_BITS, bool)
        self.seen[self._place(self.values)] = True

    @staticmethod
    def _place(values: np.ndarray) -> np.ndarray:
        return ((values * _MULTIPLIER) >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)

    def candidates(self, norm: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(passage, first diagonal, last diagonal)`` of the bands that reach the bound."""
        none = np.zeros(0, np.int64)
        g = grams(norm)
        p = np.flatnonzero(self.seen[self._place(g)])
        if not len(p) or not len(self.values):
            return none, none, none
        k = np.minimum(np.searchsorted(self.values, g[p]), len(self.values) - 1)
        real = self.values[k] == g[p]
        p, k = p[real], k[real]
        if not len(p):
            return none, none, none
        n = self.first[k + 1] - self.first[k]
        upto = np.cumsum(n)
        post = np.arange(upto[-1]) - np.repeat(upto - n - self.first[k], n)
        gram, at = self.gram[post].astype(np.int64), np.repeat(p, n)
        # an item's hits that no passage of it can need go first
        item = np.searchsorted(self.base, gram, side="right") - 1
        reach = int(np.diff(self.base).max())
        span = len(norm) + reach + 2
        key, band, count = np.unique(item * span + (at - gram + self.base[item] + reach) // (self.item_budget[item] + 1), return_inverse=True, return_counts=True)
        enough = count + self._next(key, count) >= self.item_least[key // span]
        enough[1:] |= (key[1:] == key[:-1] + 1) & enough[:-1]
        needed = enough[band]
        gram, at, item = gram[needed], at[needed], item[needed]
        found = [self._bands(*size, gram, at, self.base[item], len(norm)) for size in self.sizes]
        return tuple(np.concatenate(x) for x in zip(*found))

    @staticmethod
    def _next(key: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Hits of the next band, which overlaps by half."""
        after = np.zeros(len(key), np.int64)
        after[:-1] = np.where(key[1:] == key[:-1] + 1, count[1:], 0)
        return after

    def _bands(self, width: int, begin: int, end: int, gram: np.ndarray, at: np.ndarray, base: np.ndarray, room: int):
        """Bands of the passages of one size, for hits of ``gram`` (a place in the
        pool, its item from ``base`` on) at ``at`` of the text."""
        starts = self.start[begin:end]
        low = np.searchsorted(starts, np.maximum(gram + Q - width, base), side="left")
        n = np.maximum(np.searchsorted(starts, gram, side="right") - low, 0)
        passage = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - low, n) + begin
        diagonal = np.repeat(at - gram, n) + self.start[passage]
        step = self.budget[passage] + 1
        span = room + width + 2
        key, count = np.unique(passage * span + (diagonal + width) // step, return_counts=True)
        after = self._next(key, count)
        passage = key // span
        good = count + after >= self.least[passage]
        before = np.zeros(len(key), bool)               # the same hits seen from the band before are enough once
        before[1:] = (key[1:] == key[:-1] + 1) & good[:-1] & (after[1:] == 0)
        good &= ~before
        passage, band = passage[good], (key % span)[good]
        lo = band * (self.budget[passage] + 1) - width
        return passage, lo, lo + 2 * (self.budget[passage] + 1) - 1

    def exact_places(self, norm: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """``(item, start, end)`` of short items between word borders."""
        if not self.exact:
            return
        border = np.concatenate(([True], (norm == 0x20) | (norm == SEPARATOR), [True]))     # of the place before
        starts = np.flatnonzero(border[:-2] & ~border[1:-1])
        g = grams(np.concatenate((norm, np.full(Q, SEPARATOR, np.uint8))))
        for m, of in self.exact.items():
            at = starts[starts + m <= len(norm)]
            at = at[border[at + m + 1]]
            at = at[np.isin(g[at] & np.uint64((1 << 8 * min(m, Q)) - 1), self.heads[m])]
            for s in at.tolist():
                for item in of.get(norm[s:s + m].tobytes(), ()):
                    yield item, s, s + m


_EDIT = 1 << 12     # a cell holds the edits in units of this, and below them the start's place in the band


def align(index: Index, passage: np.ndarray, norm: np.ndarray, lo: np.ndarray, hi: np.ndarray,
          left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(edits, start, end)`` of the best banded alignment of each whole passage
    with starts on its diagonals, inside its row ``left..right`` of the text.

    All candidates step through their passages together, one array operation a
    step; those beyond their budget drop out.  Dropped ones get more edits than
    their budget.
    """
    m, budget = index.length[passage], index.budget[passage]
    s = np.maximum(left, lo - budget)
    e = np.minimum(right, hi + m + budget + 1)
    width = int((hi - lo + 2 + 3 * budget).max())
    edits, start, end = budget + 1, s.copy(), s.copy()
    text = np.concatenate((norm, np.zeros(width + int(m.max()) + 1, np.uint8)))
    pattern = np.zeros((len(m), int(m.max())), np.uint8)
    for i, k in enumerate(index.start[passage].tolist()):
        pattern[i, :m[i]] = index.pool[k:k + m[i]]
    j = np.arange(width, dtype=np.int32)
    live = np.flatnonzero(s < e)
    row = np.repeat(j[None, :], len(live), axis=0)
    for i in range(int(m.max())):
        done = m[live] == i
        stuck = row.min(axis=1) // _EDIT > budget[live] if i % 8 == 0 or done.any() else done
        if done.any():
            at = np.flatnonzero(done & ~stuck)
            _finish(row[at], live[at], m, s, e, edits, start, end)
        if (done | stuck).any():
            live, row = live[~(done | stuck)], row[~(done | stuck)]
        if not len(live):
            return edits, start, end
        place = (s[live] + i)[:, None] + j
        same = (text[place] == pattern[live, i][:, None]) & (place < e[live][:, None])
        new = row + np.where(same, 0, _EDIT).astype(np.int32)
        new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + _EDIT)              # a passage byte without partner
        row = np.minimum.accumulate(new - j * _EDIT, axis=1) + j * _EDIT       # text bytes without partner
    _finish(row, live, m, s, e, edits, start, end)
    return edits, start, end


def _finish(row, live, m, s, e, edits, start, end) -> None:
    if not len(live):
        return
    stop = (s[live] + m[live])[:, None] + np.arange(row.shape[1])
    row = np.where(stop <= e[live][:, None], row, np.int32(1 << 30))
    k = row.argmin(axis=1)
    best = row[np.arange(len(live)), k]
    edits[live] = best // _EDIT
    start[live] = s[live] + best % _EDIT
    end[live] = stop[np.arange(len(live)), k]


def matches(index: Index, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
    """``(row, item, start byte, end byte, edits)`` of rows that each end in one
    byte to spare; the best place of each item in each row where places overlap."""
    norm, at = normalize(data, offsets[1:] - 1)
    ends = np.flatnonzero(norm == SEPARATOR)
    found: dict[tuple[int, int], list] = {}
    for item, s, e in index.exact_places(norm):
        found.setdefault((int(np.searchsorted(ends, s)), item), []).append((s, e, 0))
    passage, lo, hi = index.candidates(norm)
    if len(passage):
        _aligned(index, norm, ends, passage, lo, hi, found)
    for (r, item), places in sorted(found.items()):
        places.sort()
        merged = [list(places[0])]
        for s, e, d in places[1:]:
            if s <= merged[-1][1]:
                merged[-1] = [merged[-1][0], max(e, merged[-1][1]), min(d, merged[-1][2])]
            else:
                merged.append([s, e, d])
        for s, e, d in merged:
            yield r, item, int(at[s] - offsets[r]), int(at[e - 1] + 1 - offsets[r]), d


def _aligned(index: Index, norm: np.ndarray, ends: np.ndarray, passage: np.ndarray, lo: np.ndarray, hi: np.ndarray, found: dict) -> None:
    """Adds the verified places to ``found``, by row and item."""
    # a band may touch several rows; each is tried
    first = np.searchsorted(ends, np.maximum(lo, 0))
    last = np.minimum(np.searchsorted(ends, np.minimum(hi + index.length[passage], len(norm) - 1)), len(ends) - 1)
    n = last - first + 1
    who = np.repeat(np.arange(len(passage)), n)
    row = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n) + first[who]
    passage, lo, hi = passage[who], lo[who], hi[who]
    left, right = np.where(row > 0, ends[row - 1] + 1, 0), ends[row]
    room = np.minimum(right, hi + index.length[passage]) - np.maximum(left, lo) >= index.length[passage] - index.budget[passage]
    order = np.flatnonzero(room)
    order = order[np.argsort(index.length[passage[order]], kind="stable")]
    for i in range(0, len(order), 2048):
        k = order[i:i + 2048]
        edits, start, end = align(index, passage[k], norm, lo[k], hi[k], left[k], right[k])
        good = edits <= index.budget[passage[k]]
        for r, p, s, e, d in zip(row[k][good].tolist(), passage[k][good].tolist(), start[good].tolist(), end[good].tolist(), edits[good].tolist()):
            found.setdefault((r, int(index.item[p])), []).append((s, e, d))


def _rows(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[bytes], np.ndarray, np.ndarray]]:
    """Slices of a batch as ``(first row, texts, joined bytes, offsets)``."""
    data, offsets, _ = utf8(batch.column(column))
    raw = memoryview(data)
    for i, j in row_slices(offsets, 1 << 20):
        texts = [bytes(raw[s:e]) for s, e in zip(offsets[i:j].tolist(), offsets[i + 1:j + 1].tolist())]
        at = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts]))).astype(np.int64)
        yield i, texts, np.frombuffer(b"\n".join([*texts, b""]), np.uint8), at


def _find(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            ids = batch.column(0)
            for i, texts, data, at in _rows(batch, 1):
                for row, item, s, e, d in matches(shared.value, data, at):
                    start = len(texts[row][:s].decode("utf-8", "ignore"))
                    out.append((ids[i + row].as_py(), item, start, start + len(texts[row][s:e].decode("utf-8", "ignore")), d))
            cols = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["id", "item_id", "start", "end", "edits"])
    return run


def _clean(shared, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(len(batch), bool)
            for i, _, data, at in _rows(batch, text_at):
                keep[[i + row for row, *_ in matches(shared.value, data, at)]] = False
            yield batch.filter(pa.array(keep))
    return run


def _leaking(shared):
    """The digests of the texts that hold a passage."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = set()
            for _, texts, data, at in _rows(batch, 0):
                out |= {hashlib.sha256(texts[row]).hexdigest() for row in {r for r, *_ in matches(shared.value, data, at)}}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(out), pa.string())], ["digest"])
    return run


class Items:
    """The distinct texts of a benchmark, dealt into blocks of about ``index_bytes``.

    Items of one text are indexed once under the smallest of their ids (``key``); the
    others are joined to the findings (:meth:`all_items`)."""

    def __init__(self, benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", index_bytes: int = 8 << 20, **options):
        items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(text_col).cast("string").alias("text"))
        self.items = items.where("text IS NOT NULL AND item IS NOT NULL")
        each = self.items.groupBy("text").agg(F.min("item").alias("key"), F.count(F.lit(1)).alias("n"))
        self.texts, self.options = written(each, "benchmark-texts"), options
        total, self.repeated = self.texts.agg(F.sum(F.octet_length("text")), F.coalesce(F.max("n"), F.lit(0)) > 1).first()
        self.blocks = max(1, -(-(total or 0) // index_bytes))

    def index(self, block: int):
        """The broadcast index of one block."""
        rows = self.texts.where(F.pmod(F.xxhash64("text"), F.lit(self.blocks)) == block).select("key", "text").collect()
        return self.texts.sparkSession.sparkContext.broadcast(Index(sorted((r["key"], r["text"]) for r in rows), **self.options))

    def findings(self, rows: DataFrame, how, schema: str) -> DataFrame:
        """``rows.mapInArrow(how(index), schema)`` over all blocks.  One block stays part of
        the plan.  Of several, each one's findings are written and its index dropped
        before the next, so one index is alive at a time however many there are."""
        if self.blocks == 1:
            return rows.mapInArrow(how(self.index(0)), schema)
        spark, paths = rows.sparkSession, []
        for block in range(self.blocks):
            shared = self.index(block)
            paths.append(scratch_path(spark, "benchmark-findings"))
            rows.mapInArrow(how(shared), schema).write.parquet(paths[-1])
            shared.destroy()
        return spark.read.schema(schema).parquet(*paths)

    def all_items(self, found: DataFrame) -> DataFrame:
        """Findings with a row for each item that has the text found."""
        if not self.repeated:
            return found
        same = self.items.join(self.texts.where("n > 1").select("text", F.col("key").alias("item_id")), "text").select("item_id", "item").distinct()
        item = F.coalesce("item", "item_id").alias("item_id")
        return found.join(same, "item_id", "left").select(*[item if c == "item_id" else c for c in found.columns])


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``(id, item_id, start, end, edits)``: the places of benchmark passages; no
    row for a clean document."""
    small_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    items = Items(benchmark, **options)
    return items.all_items(items.findings(src, _find, "id long, item_id long, start long, end long, edits long"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` (all columns) without the documents that hold a benchmark passage.

    With several blocks of items the digests of leaking texts are written block by
    block and joined at the end: the documents are read again, never written."""
    small_batches(docs.sparkSession)
    items = Items(benchmark, **options)
    if items.blocks == 1:
        return docs.mapInArrow(_clean(items.index(0), docs.columns.index(text_col)), docs.schema)
    found = items.findings(docs.select(F.col(text_col).cast("string").alias("text")), _leaking, "digest string").distinct()
    text = F.col(f"`{text_col}`").cast("string")
    name = "_" * max(map(len, docs.columns)) + "digest"            # no column has it
    return docs.withColumn(name, F.sha2(text.cast("binary"), 256)).join(found.withColumnRenamed("digest", name), name, "left_anti").select(*docs.columns)
