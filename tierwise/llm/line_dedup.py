"""Line dedup by a segment-partition edit join.

Equal lines are one class, and so are lines that differ by few edits, and chains of
them; of each class the first line (smallest document id, then line number)
stays and every other line goes, copies included.  How many edits depends on the
shorter line: one for each ``segment_chars`` characters beyond the first
``segment_chars``, ``max_edits`` at most (by default none below 16 characters, one
below 24, then two).

A line is split into one segment more than its edits, of even length.  Two lines within
the threshold share a whole segment, so the substrings of a line at the places
where it may meet a segment of a line of its own or a smaller length are looked
up by (length, segment number, content); a line's own segments are the index
entries among them.  Rows of the index are two numbers, the key and the line's
name, whose lower half is a parity sketch of its character pairs: an edit flips at most
four of its bits, which drops most false partners before any text moves.  Only
lines with a possible partner are fetched; pairs are verified by a banded
bit-parallel edit distance.  Names only filter: from the texts on a line is a number
of its own, so that two lines of one name stay two (a link between them alone is
lost, in one of 2**32).

A key yields a spanning forest of its links, not all pairs; keys with more than
``block_rows`` lines or ``block_bytes`` of long ones are dealt by pairs of blocks.  A
frequent line's keys leave a task once; its copies meet in a grouped minimum, which
combines before the shuffle.

Defined cases: a null text stays null and an empty one empty; blank lines and
lines shorter than ``least_chars`` always stay; rows alike in id and text are judged as
one document, and so keep the same lines; other rows with one id, or without one, are
documents of their own, in order of the hash of their text; documents stay even if all
their lines go; an empty table gives an empty result; columns other than id and text
are passed through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import connected_components, fresh, member_words, row_slices, split_by_members, utf8, written

_BASE = 0x9E3779B97F4A7C15
_POWERS: list = []
_SOLID = np.ones(256, bool)
_SOLID[[9, 10, 11, 12, 13, 32]] = False
SKETCH_BITS = 32
RECENT = 1 << 17        # digests of a generation that a task remembers
LONG_BYTES = 1 << 14    # of a line whose size counts where blocks are dealt


class Recent:
    """What a task met lately, in two generations of bounded size."""

    def __init__(self, most: int = RECENT):
        self.most, self.new, self.old = most, set(), set()

    def unseen(self, items: list) -> np.ndarray:
        """Places of the items that were not met lately; they are from now on."""
        at = []
        for i, x in enumerate(items):
            if x not in self.new and x not in self.old:
                at.append(i)
                self.new.add(x)
                if len(self.new) >= self.most:
                    self.new, self.old = set(), self.new
        return np.array(at, np.int64)


def allowed_edits(chars, most: int, segment_chars: int):
    """Edits that lines of so many characters may differ by."""
    return np.clip(np.asarray(chars) // segment_chars - 1, 0, most)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        both = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _POWERS[:] = both
    return _POWERS[0], _POWERS[1]


def selections(edits: int, delta: int, i: int, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(first place, last place, size)`` at which a line may hold segment ``i`` of
    a line of ``length`` that is shorter by ``delta``: the places from which the
    edits left and right of the segment can still add up to the threshold."""
    parts = edits + 1
    even, longer = length // parts, length % parts         # the last segments take the rest
    size = even + (i >= parts - longer)
    at = i * even + np.maximum(0, i - (parts - longer))
    lo = np.maximum(np.maximum(0, at - i), at + delta - (edits - i))
    hi = np.minimum(np.minimum(length + delta - size, at + i), at + delta + (edits - i))
    return lo, hi, size


class Lines:
    """The lines of a slice of texts: joined bytes with a line end after each row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = data
        self.end = np.flatnonzero(data == 10)
        self.start = np.concatenate(([0], self.end[:-1] + 1)) if len(self.end) else self.end
        self.row = np.searchsorted(offsets, self.start, side="right") - 1
        first = np.searchsorted(self.start, offsets[:-1])
        self.number = np.arange(len(self.start)) - first[self.row]
        self.points = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        self.first = np.searchsorted(self.points, self.start)
        self.chars = np.searchsorted(self.points, self.end) - self.first

    def blank(self) -> np.ndarray:
        """Lines of white space only."""
        solid = np.concatenate(([0], np.cumsum(_SOLID[self.data])))
        return solid[self.end] == solid[self.start]

    def digests(self, which: np.ndarray) -> list[bytes]:
        raw = self.data.tobytes()
        return [xxhash.xxh3_128_digest(raw[s:e]) for s, e in zip(self.start[which].tolist(), self.end[which].tolist())]

    def names(self, which: np.ndarray, digests: list[bytes]) -> np.ndarray:
        """64-bit name of each line: 32 bits of its digest, then its sketch."""
        at = self.points[:-1]
        x = self.data[at].astype(np.uint32)
        if len(at) < len(self.data):        # characters of several bytes
            padded = np.concatenate((self.data, np.zeros(3, np.uint8)))
            more = np.ones(len(at), bool)
            for k in (1, 2, 3):
                byte = padded[at + k]
                more &= (byte & 0xC0) == 0x80
                x += np.where(more, byte, 0).astype(np.uint32) << np.uint32(8 * k)
        pair = np.zeros(len(x), np.uint32)
        pair[:-1] = (x[:-1] * np.uint32(0x9E3779B1)) ^ (x[1:] * np.uint32(0x85EBCA6B))
        pair = (pair * np.uint32(0xC2B2AE35)) >> np.uint32(32 - 5)
        bits = np.concatenate((np.zeros(1, np.uint32), np.bitwise_xor.accumulate(np.uint32(1) << pair)))
        first = self.first[which]
        sketch = bits[first + np.maximum(self.chars[which] - 1, 0)] ^ bits[first]
        top = np.frombuffer(b"".join([d[:4] for d in digests]), ">u4").astype(np.uint64)
        return ((top << np.uint64(SKETCH_BITS)) | sketch).view(np.int64)

    def keys(self, which: np.ndarray, most: int, segment_chars: int) -> tuple[np.ndarray, np.ndarray]:
        """``(line, key)`` of every substring that may meet a segment."""
        power, inverse = _powers(len(self.data) + 1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * power[:len(self.data)], dtype=np.uint64)))
        lines, keys = [], []
        for delta, edits in [(d, t) for d in range(most + 1) for t in range(max(d, 1), most + 1)]:
            of = which[allowed_edits(self.chars[which] - delta, most, segment_chars) == edits]
            length = self.chars[of] - delta
            for i in range(edits + 1):
                lo, hi, size = selections(edits, delta, i, length)
                tag = (length.astype(np.uint64) * np.uint64(64) + np.uint64(i)) * np.uint64(0xD6E8FEB86659FD93)
                for step in range(2 * edits + 1):
                    at = np.flatnonzero(lo + step <= hi)
                    if not len(at):
                        break
                    p = self.first[of[at]] + lo[at] + step
                    s, e = self.points[p], self.points[p + size[at]]
                    h = (sums[e] - sums[s]) * inverse[s] + tag[at]
                    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
                    lines.append(of[at])
                    keys.append(h ^ (h >> np.uint64(29)))
        if not lines:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(lines), np.concatenate(keys).view(np.int64)


def _slices(batch: pa.RecordBatch, column: int, size: int = 1 << 20) -> Iterator[tuple[int, Lines]]:
    data, offsets, _ = utf8(batch.column(column))
    raw = memoryview(data)
    for i, j in row_slices(offsets, size):
        texts = [bytes(raw[s:e]) for s, e in zip(offsets[i:j].tolist(), offsets[i + 1:j + 1].tolist())]
        at = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts]))).astype(np.int64)
        yield i, Lines(np.frombuffer(b"\n".join([*texts, b""]), np.uint8), at)


def _places(least_chars: int):
    """Every line that may go: digest, name, document and line number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column(0), batch.column(2)
            for i, lines in _slices(batch, 1):
                which = np.flatnonzero((lines.chars >= least_chars) & ~lines.blank())
                digests = lines.digests(which)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests, pa.binary()), pa.array(lines.names(which, digests)) if len(which) else pa.array([], pa.int64()),
                     *[c.take(pa.array(i + lines.row[which])) for c in (ids, rows)], pa.array(lines.number[which].astype(np.int32))], ["digest", "name", "id", "row", "line"])
    return run


def _near_lines(batches: Iterator[pa.RecordBatch], segment_chars: int) -> Iterator[tuple[Lines, np.ndarray, list[bytes]]]:
    """The lines long enough for near matches, with their digests; copies that a task
    met lately are left out."""
    recent = Recent()
    for batch in batches:
        for _, lines in _slices(batch, 1):
            which = np.flatnonzero((lines.chars >= 2 * segment_chars) & ~lines.blank())
            digests = lines.digests(which)
            at = recent.unseen(digests)
            if len(at):
                yield lines, which[at], [digests[i] for i in at.tolist()]


def _signatures(edits: int, segment_chars: int):
    """``(key, name)`` of the lines long enough for near matches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lines, which, digests in _near_lines(batches, segment_chars):
            name_of = np.zeros(len(lines.start), np.int64)
            name_of[which] = lines.names(which, digests)
            line, key = lines.keys(which, edits, segment_chars)
            for a in range(0, len(key), 65536):
                yield pa.RecordBatch.from_arrays([pa.array(key[a:a + 65536]), pa.array(name_of[line[a:a + 65536]])], ["key", "name"])
    return run


def _partners(edits: int, most: int = 2048):
    """Rows of keys that several lines have, if the sketch of one allows another.
    Rows come in order and leave once each; of a key with more than ``most`` names
    all pass."""
    limit = 4 * edits
    low = np.int64((1 << SKETCH_BITS) - 1)

    def choose(key, name):
        cuts = np.flatnonzero(np.diff(key)) + 1
        start, end = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(key)]))
        keep = np.zeros(len(key), bool)
        two = start[end - start == 2]
        near = np.bitwise_count((name[two] ^ name[two + 1]) & low) <= limit
        keep[two[near]] = keep[two[near] + 1] = True
        for s, e in zip(start[end - start > 2].tolist(), end[end - start > 2].tolist()):
            if e - s > most:
                keep[s:e] = True
                continue
            sketch = name[s:e] & low
            near = np.bitwise_count(sketch[:, None] ^ sketch[None, :]) <= limit
            keep[s:e] = near.sum(axis=1) > 1
        return key[keep], name[keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, name = np.zeros(0, np.int64), np.zeros(0, np.int64)
        before, large = None, None      # the row read last, and the key whose names pass as they come
        for batch in batches:
            k, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            if not len(k):
                continue
            new = np.ones(len(k), bool)
            new[1:] = (k[1:] != k[:-1]) | (n[1:] != n[:-1])
            new[0] = before != (k[0], n[0])
            before = (k[-1], n[-1])
            key, name = np.concatenate((key, k[new])), np.concatenate((name, n[new]))
            if large is not None:
                at = int(np.searchsorted(key, large, side="right"))
                if at:
                    yield pa.RecordBatch.from_arrays([pa.array(key[:at]), pa.array(name[:at])], ["key", "name"])
                    key, name = key[at:], name[at:]
            last = int(np.searchsorted(key, key[-1], side="left")) if len(key) else 0
            if last:
                k, n = choose(key[:last], name[:last])
                key, name = key[last:], name[last:]
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(n)], ["key", "name"])
            if len(key) > most:
                large = key[0]
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(name)], ["key", "name"])
                key, name = key[:0], name[:0]
        if len(key):
            k, n = choose(key, name)
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(n)], ["key", "name"])
    return run


def edit_distance(a: str, b: str, most: int) -> int:
    """Edit distance if at most ``most``, else ``most + 1``: equal ends cut off, then
    the bit-parallel column of a band of ``2 * most + 1`` diagonals in one integer."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    s, n = 0, min(len(a), len(b))
    step = 64
    while s < n:        # common beginning, in strides that shrink to one character
        if a[s:s + step] == b[s:s + step]:
            s += min(step, n - s)
        elif step == 1:
            break
        else:
            step = max(1, step // 8)
    a, b = a[s:], b[s:]
    n, e, step = min(len(a), len(b)), 0, 64
    while e < n:
        k = min(step, n - e)
        if a[len(a) - e - k:len(a) - e] == b[len(b) - e - k:len(b) - e]:
            e += k
        elif step == 1:
            break
        else:
            step = max(1, step // 8)
    a, b = a[:len(a) - e], b[:len(b) - e]
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return min(len(b), most + 1)
    # a state per number of edits: bit d is the diagonal d - most, set if the
    # prefix of b read so far reaches it with that many edits (Wu and Manber)
    width = 2 * most + 1
    full = (1 << width) - 1
    states = []
    for k in range(most + 1):       # before b is read: k bytes of a at most left out
        states.append(sum(1 << (most + i) for i in range(min(k, len(a)) + 1)) & full)
    for j, c in enumerate(b):
        # bit d: the character of a at place j + d - most equals c
        lo = j - most
        equal = 0
        for d in range(width):
            if 0 <= lo + d < len(a) and a[lo + d] == c:
                equal |= 1 << d
        room = full
        new, below_old, below_new = [], 0, 0
        for k, old in enumerate(states):
            now = old & equal                                   # same diagonal, characters equal
            if k:
                now |= below_old                                # substituted
                now |= below_old >> 1                           # character of b without partner
            # diagonals outside of a cannot be substituted or matched
            inside = 0
            for d in range(width):
                if 0 <= lo + d + 1 <= len(a):
                    inside |= 1 << d
            now &= inside & room
            if k:
                now |= (below_new << 1) & inside & full         # character of a without partner
            new.append(now)
            below_old, below_new = old, now
        states = new
        if not states[-1]:
            return most + 1
    goal = 1 << (len(a) - len(b) + most)
    for k, state in enumerate(states):
        if state & goal:
            return k
    return most + 1


def _verify(edits: int, segment_chars: int):
    """Links of one key (or of two of its blocks) at a time."""
    def links(rows):
        nodes, texts = np.array([r[0] for r in rows], np.int64), [r[2] for r in rows]
        sketch = np.array([r[1] for r in rows], np.int64) & np.int64((1 << SKETCH_BITS) - 1)
        left = np.array([r[3] for r in rows], bool)
        size = np.array([len(t) for t in texts])
        two = left.any() and not left.all()
        first = np.flatnonzero(left) if two else np.arange(len(rows))
        second = np.flatnonzero(~left) if two else first
        parent = list(range(len(rows)))

        def find(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x
        for i in first.tolist():
            most = allowed_edits(np.minimum(size[second], size[i]), edits, segment_chars)
            near = (np.bitwise_count(sketch[second] ^ sketch[i]) <= 4 * most) & (np.abs(size[second] - size[i]) <= most) & (nodes[second] != nodes[i])
            if not two:
                near &= second > i
            for j, within in zip(second[near].tolist(), most[near].tolist()):
                x, y = find(i), find(j)
                if x != y and edit_distance(texts[i], texts[j], within) <= within:
                    parent[x] = y
                    yield int(nodes[i]), int(nodes[j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def out():
            found = list(links(held))
            cols = list(zip(*found)) or [[], []]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b"])
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if row[0] != key and held:
                    if len(held) > 1:
                        yield out()
                    held = []
                key = row[0]
                held.append(row[1:])
        if len(held) > 1:
            yield out()
    return run


def _texts(segment_chars: int):
    """``(digest, text)`` of the lines long enough for near matches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lines, which, digests in _near_lines(batches, segment_chars):
            raw = lines.data.tobytes()
            text = [raw[s:e].decode("utf-8", "replace") for s, e in zip(lines.start[which].tolist(), lines.end[which].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(text, pa.string())], ["digest", "text"])
    return run


def near_links(src: DataFrame, firsts: DataFrame, edits: int, segment_chars: int, block_rows: int, block_bytes: int) -> DataFrame:
    """``(a, b)``: nodes of lines within their edits, spanning every class."""
    signed = src.mapInArrow(_signatures(edits, segment_chars), "key long, name long")
    live = written(signed.repartition("key").sortWithinPartitions("key", "name").mapInArrow(_partners(edits), "key long, name long"), "lines-live")
    wanted = written(firsts.join(live.select("name").distinct(), "name", "left_semi").select("digest", "name", "node", "first.row"), "lines-wanted")
    holders, _ = split_by_members(src, "row", member_words(wanted.select("row")))
    texts = written(holders.mapInArrow(_texts(segment_chars), "digest binary, text string").join(wanted.drop("row"), "digest")
                    .dropDuplicates(["node"]).select("name", "node", "text"), "lines-texts")
    size = F.octet_length("text")
    long = written(texts.where(size > LONG_BYTES).select("name", size.alias("bytes")), "lines-long")
    # only the keys of several blocks, as a rule few or none: the lines of the others are not moved to meet them
    parts = F.greatest(F.ceil(F.count("*") / F.lit(block_rows)), F.ceil(F.sum("bytes") / F.lit(block_bytes))).cast("int")
    blocks = written(live.join(long, "name", "left").groupBy("key").agg(parts.alias("blocks")).where("blocks > 1"), "lines-blocks")
    dealt = (live.join(blocks, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("own", F.expr("cast(pmod(xxhash64(name), blocks) AS int)"))
             .withColumn("k", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(F.when(F.col("blocks") == 1, F.col("key")).otherwise(F.xxhash64("key", F.least("own", "k"), F.greatest("own", "k"))).alias("key"),
                     "name", F.expr("own <= k").alias("left")))
    rows = dealt.join(texts, "name").select("key", "node", "name", "text", "left")
    return written(rows.repartition("key").sortWithinPartitions("key", "node").mapInArrow(_verify(edits, segment_chars), "a long, b long"), "lines-links")


def _row(id_col: str, text_col: str):
    """Key of a row: rows that share an id, or have none, still differ by text."""
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string"))


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_edits: int = 2, least_chars: int = 1,
                  segment_chars: int = 8, block_rows: int = 2048, block_bytes: int = 32 << 20) -> DataFrame:
    """``(id, row, lines)``: numbers (from 0, in order) of the lines that go, for each
    document that has any; ``row`` is the hash of id and text."""
    if segment_chars < 4:
        raise ValueError("lines for near matches need segments of four characters or more")
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), _row(id_col, text_col).alias("row"))
    places = written(src.mapInArrow(_places(least_chars), "digest binary, name long, id long, row long, line int"), "lines-places")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "row", "line")
    firsts = places.groupBy("digest").agg(F.min(place).alias("first"), F.first("name").alias("name"), F.count("*").alias("n"))
    firsts = written(firsts.withColumn("node", F.monotonically_increasing_id()), "lines-first")     # read back, so the numbers stay
    comp = connected_components(near_links(src, firsts, max_edits, segment_chars, block_rows, block_bytes), "lines-cc")
    classed = firsts.join(comp, "node", "left").where("n > 1 OR component IS NOT NULL")
    linked = classed.where("component IS NOT NULL").union(
        firsts.join(comp.select(F.col("component").alias("node")).distinct(), "node", "left_semi").withColumn("component", F.col("node")).select(classed.columns))
    heads = linked.groupBy("component").agg(F.min("first").alias("head"))
    chosen = (linked.join(heads, "component").select("digest", "head")
              .union(classed.where("component IS NULL").select("digest", F.col("first").alias("head"))))
    # written, so that both sides of the join are shuffled and Spark can split a frequent line
    chosen = written(chosen.groupBy("digest").agg(F.min("head").alias("head")), "lines-chosen")
    gone = places.join(chosen, "digest").where(~(place == F.col("head")))
    return gone.select("id", "row", "line").distinct().groupBy("id", "row").agg(F.array_sort(F.collect_list("line")).alias("lines"))


def line_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``(id, n_lines, n_removed, removed)``, one row per document; ``removed`` are
    the numbers of the lines that go, comma-joined."""
    gone = dropped_lines(docs, id_col, text_col, **options).withColumnsRenamed({"id": "gone_id", "row": "gone_row"})
    counts = docs.select(F.col(id_col).cast("long").alias("id"), _row(id_col, text_col).alias("row"), F.coalesce(F.size(F.split(F.col(text_col).cast("string"), "\n", -1)), F.lit(0)).alias("n_lines"))
    return (counts.join(gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("row") == F.col("gone_row")), "left")
            .select("id", F.when(F.col("n_lines") < 0, 0).otherwise(F.col("n_lines")).cast("long").alias("n_lines"),
                    F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_removed"), F.coalesce(F.array_join("lines", ","), F.lit("")).alias("removed")))


def _without(id_at: int, text_at: int, lines_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, lines in zip(batch.column(text_at).to_pylist(), batch.column(lines_at).to_pylist()):
                if text is not None and lines:
                    gone = set(lines)
                    text = "\n".join([x for i, x in enumerate(text.split("\n")) if i not in gone])
                texts.append(text)
            cols = [pa.array(texts, pa.string()) if i == text_at else c for i, c in enumerate(batch.columns) if i != lines_at]
            yield pa.RecordBatch.from_arrays(cols, [n for i, n in enumerate(batch.schema.names) if i != lines_at])
    return run


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` (all rows and columns) with the lines that go cut from the text.
    Only documents that lose a line are shuffled."""
    gone = written(dropped_lines(docs, id_col, text_col, **options), "lines-gone")
    of, of_row, lines, row = fresh(docs, "__gone_id", "__gone_row", "__gone_lines", "__row")
    some, none = split_by_members(docs.withColumn(row, _row(id_col, text_col)), row, member_words(gone.select("row")))
    same = F.col(id_col).cast("long").eqNullSafe(F.col(of)) & (F.col(row) == F.col(of_row))
    joined = some.join(gone.toDF(of, of_row, lines), same, "left").drop(of, of_row, row)
    cut = joined.mapInArrow(_without(docs.columns.index(id_col), docs.columns.index(text_col), len(docs.columns)), docs.schema)
    return cut.union(none.drop(row))
