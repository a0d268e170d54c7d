"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Vectors are put on an integer grid, so scores (inner products) are exact.  Candidates
are ordered by label and place on a Hilbert curve and written as blocks of up to
``block_rows`` neighbours, one Parquet record a block, each with the smallest and the
largest value of every dimension (its zone map).  The interval product of an anchor with
a zone map bounds all scores in the block from both sides without reading it.

A search has windows of scores per anchor and wants the best ``k`` rows of each.  Blocks
whose bounds miss all windows of an anchor are never read for it.  Of the others the
``seeds`` with the highest bounds are read first; the ``k``-th best score found so far
raises the floor of a window, and only blocks that still reach over it are read after
that.  Positives are the search with one open window among the rows of the anchor's
label, negatives the one with a window for each positive among the other labels.

Scale: anchors (the stated query set) and zone maps meet in pieces of bounded size, and
the zone maps, not the rows, are what every anchor meets.  Only the blocks that some
anchor must read are shuffled, each beside a bounded slice of its anchors, whatever their
number; a hot label is many blocks, copies too.  Each block returns at most ``k`` rows
for a window, which are ranked with a limit before the shuffle.  Nothing is broadcast by
hint or collected but counts and the moments of the dimensions.

Defined cases: a row with a null label, a null vector, a null or non-finite component,
or entries so large that a score could leave 64 bits (``width * max**2 >= 2**62``) takes
no part; vectors of different widths never meet, empty ones have score 0; a row is never
its own partner, but rows with equal ids or vectors are rows of their own; ties go by the
smaller id, null ids last; a positive with a negative score has an empty window; fewer
rows than asked for are all returned; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierwise.llm.common import written

OPEN = 2**62
ROWS = "id long, row long, label string, anchor boolean, width int, q binary"
BLOCK = "block long, label string, width int, n int, ids array<long>, rows array<long>, anchors array<boolean>, q binary, low array<int>, high array<int>"


def hilbert_keys(x: np.ndarray, bits: int) -> list[bytes]:
    """Place on the Hilbert curve of points with coordinates of ``bits`` bits, as bytes
    that sort in the curve's order (Skilling's transform, all points at once)."""
    n, d = x.shape
    if not d:
        return [b""] * n
    c = [x[:, i].astype(np.uint32) for i in range(d)]
    q = 1 << (bits - 1)
    while q > 1:
        p = np.uint32(q - 1)
        for i in range(d):
            hit = (c[i] & q) != 0
            swap = np.where(hit, 0, (c[0] ^ c[i]) & p).astype(np.uint32)
            c[0] = c[0] ^ np.where(hit, p, swap)
            if i:
                c[i] = c[i] ^ swap
        q >>= 1
    for i in range(1, d):
        c[i] = c[i] ^ c[i - 1]
    turn, q = np.zeros(n, np.uint32), 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((c[d - 1] & q) != 0, q - 1, 0).astype(np.uint32)
        q >>= 1
    planes = np.stack([((v ^ turn) >> b) & 1 for b in range(bits - 1, -1, -1) for v in c], axis=1)
    return [k.tobytes() for k in np.packbits(planes.astype(np.uint8), axis=1)]


def _grid(grid: int):
    """Sound rows with their grid vector (32-bit little-endian)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec = batch.column(4)
            there = np.asarray(vec.is_valid())
            width = np.where(there, vec.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0).astype(np.int64)
            values = vec.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
            with np.errstate(invalid="ignore", over="ignore"):
                x = np.floor(values * grid)
                fits = np.repeat(width, width) * x * x < OPEN
            bad, ends = np.concatenate([[0], np.cumsum(~fits)]), np.cumsum(width)
            at = np.flatnonzero(there & (bad[ends] == bad[ends - width]))
            x = np.where(fits, x, 0).astype("<i4")
            take = pa.array(at)
            q = [x[ends[i] - width[i]:ends[i]].tobytes() for i in at.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(i).take(take) for i in range(4)] + [pa.array(width[at].astype(np.int32)), pa.array(q, pa.binary())],
                                             ["id", "row", "label", "anchor", "width", "q"])
    return run


def _values(column, width: int) -> np.ndarray:
    """Grid vectors of one width as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(len(column), width).astype(np.int64)


def _moments(width: int):
    """``(dimension, number, sum, sum of squares)`` of a task's vectors of one width."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, t = 0, np.zeros(width), np.zeros(width)
        for batch in batches:
            x = _values(batch.column(0), width).astype(np.float64)
            n, s, t = n + len(x), s + x.sum(axis=0), t + (x * x).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(np.full(width, float(n))), pa.array(s), pa.array(t)], ["dim", "n", "s", "t"])
    return run


def _keyed(model: dict, bits: int):
    """Adds the Hilbert key: two deviations to each side are spread over the curve's cells
    (widths without moments as they are)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = batch.column(4).to_numpy(zero_copy_only=False)
            keys = np.empty(len(width), object)
            for w in np.unique(width).tolist():
                at = np.flatnonzero(width == w)
                x = _values(batch.column(5).take(pa.array(at)), w)
                mean, spread = model.get(w, (0.0, 128.0))
                cell = np.floor((x - mean) / (4 * spread) * (1 << bits) + (1 << (bits - 1)))
                keys[at] = hilbert_keys(np.clip(cell, 0, (1 << bits) - 1).astype(np.int64), bits)
            yield pa.RecordBatch.from_arrays(batch.columns + [pa.array(keys, pa.binary())], batch.schema.names + ["key"])
    return run


def _blocks(block_rows: int):
    """Blocks of neighbours: rows come in the order of width, label and curve."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made, held = TaskContext.get().partitionId() << 32, 0, []

        def done() -> pa.RecordBatch:
            nonlocal made, held
            (label, width), table = held[0][0], pa.Table.from_batches([h[1] for h in held]).combine_chunks()
            x = _values(table.column(5).combine_chunks(), width)
            values = [first + made, label, width, table.num_rows, table.column(0).to_pylist(), table.column(1).to_pylist(), table.column(3).to_pylist(),
                      x.astype("<i4").tobytes(), x.min(axis=0).tolist(), x.max(axis=0).tolist()]
            made, held = made + 1, []
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, TYPES)], NAMES)

        for batch in batches:
            keys = list(zip(batch.column(2).to_pylist(), batch.column(4).to_pylist()))
            at = 0
            while at < len(keys):
                if held and (held[0][0] != keys[at] or sum(h[1].num_rows for h in held) >= block_rows):
                    yield done()
                room, end = block_rows - sum(h[1].num_rows for h in held), at
                while end < len(keys) and end - at < room and keys[end] == keys[at]:
                    end += 1
                held.append((keys[at], batch.slice(at, end - at)))
                at = end
        if held:
            yield done()
    return run


NAMES = [c.split()[0] for c in BLOCK.split(", ")]
TYPES = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32())]


def candidate_blocks(vectors: DataFrame, id_col: str, vector_col: str, label: Column, anchor: Column,
                     grid: int, block_rows: int, bits: int) -> DataFrame:
    """The written blocks (:data:`BLOCK`) of all rows that take part."""
    src = vectors.select(F.col(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"), label.cast("string").alias("label"),
                         F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(vector_col).alias("vec")).where(F.col("label").isNotNull())
    rows = written(src.mapInArrow(_grid(grid), ROWS), "negatives-grid")
    model = {}
    top = rows.groupBy("width").count().orderBy(F.desc("count"), F.desc("width")).first()
    if top is not None and top["width"]:
        w = top["width"]
        parts = rows.where(F.col("width") == w).select("q").mapInArrow(_moments(w), "dim int, n double, s double, t double")
        got = parts.groupBy("dim").agg(F.sum("n"), F.sum("s"), F.sum("t")).orderBy("dim").collect()      # one row a dimension
        n, s, t = (np.array([r[i] for r in got]) for i in (1, 2, 3))
        model[w] = (s / n, np.sqrt(np.maximum(t / n - (s / n) ** 2, 1.0)))
    keyed = rows.mapInArrow(_keyed(model, bits), f"{ROWS}, key binary")
    order = ["width", "label", "key", "row"]
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("key")
    return written(dealt.mapInArrow(_blocks(block_rows), BLOCK), "negatives-blocks")


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchors among the rows of blocks (columns label, width, ids, rows, anchors, q)."""
    for batch in batches:
        for label, width, ids, rows, flags, q in zip(*(c.to_pylist() for c in batch.columns)):
            at = [i for i, f in enumerate(flags) if f]
            q = [q[4 * width * i:4 * width * (i + 1)] for i in at]
            yield pa.RecordBatch.from_arrays([pa.array([rows[i] for i in at], pa.int64()), pa.array([ids[i] for i in at], pa.int64()),
                                              pa.array([label] * len(at), pa.string()), pa.array([width] * len(at), pa.int32()), pa.array(q, pa.binary())],
                                             ["a", "anchor_id", "label", "width", "vec"])


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows with integer rows: in floating point where
    every sum is known to stay below 2**53, else in 64 bits."""
    most = a.shape[1] * np.abs(a).max(initial=0) * np.abs(b).max(initial=0)
    if most < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Interval products: smallest and largest score that a row of a block with this
    zone map can have with each anchor."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return dot(up, low) + dot(down, high), dot(up, high) + dot(down, low)


def _meet(same_label: bool):
    """Blocks whose bounds meet a window, by anchor: ``(a, block, least, most)``."""
    def run(zones: pa.Table, anchors: pa.Table) -> pa.Table:
        width = anchors["width"][0].as_py() if anchors.num_rows else 0
        parts = []
        if zones.num_rows and anchors.num_rows:
            low, high = (np.array(zones[c].to_pylist(), np.int64).reshape(zones.num_rows, width) for c in ("low", "high"))
            names = {v: i for i, v in enumerate(dict.fromkeys(zones["label"].to_pylist() + anchors["label"].to_pylist()))}
            zl, al = (np.array([names[v] for v in t["label"].to_pylist()]) for t in (zones, anchors))
            block, a = zones["block"].to_numpy(), anchors["a"].to_numpy()
            least, most = bounds(_values(anchors["vec"], width), low, high)
            near = (al[:, None] == zl[None, :]) == same_label
            meets = np.zeros_like(near)
            floors, tops = anchors["floor"].to_pylist(), anchors["top"].to_pylist()
            for i, (f, t) in enumerate(zip(floors, tops)):
                for lo, hi in zip(f, t):
                    meets[i] |= (most[i] >= lo) & (least[i] <= hi)
            i, j = np.nonzero(near & meets)
            parts = [a[i], block[j], least[i, j], most[i, j]]
        return pa.table([pa.array(p, pa.int64()) for p in parts or [[]] * 4], ["a", "block", "least", "most"])
    return run


def _reads(k: int):
    """The best ``k`` rows of a block for each window of its anchors:
    ``(a, window, row, id, score)``."""
    def run(blocks: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], []]
        if blocks.num_rows and anchors.num_rows:
            b = {c: blocks[c][0].as_py() for c in ("width", "ids", "rows", "q")}
            x = np.frombuffer(b["q"], "<i4").reshape(len(b["rows"]), b["width"]).astype(np.int64)
            # in the order that breaks ties: smaller ids first, null ids last, then rows
            order = sorted(range(len(x)), key=lambda i: (b["ids"][i] is None, b["ids"][i] or 0, b["rows"][i]))
            x, ids, rows = x[order], [b["ids"][i] for i in order], np.array(b["rows"], np.int64)[order]
            a, floors, tops = anchors["a"].to_numpy(), anchors["floor"].to_pylist(), anchors["top"].to_pylist()
            step = max(1, (4 << 20) // len(x))
            for lo in range(0, len(a), step):
                score = dot(_values(anchors["vec"].slice(lo, step), b["width"]), x)
                for i in range(len(score)):
                    s, me = score[i], a[lo + i]
                    for w, (f, t) in enumerate(zip(floors[lo + i], tops[lo + i])):
                        at = np.flatnonzero((s >= f) & (s <= t) & (rows != me))
                        if len(at) > k:
                            cut = np.partition(s[at], len(at) - k)[len(at) - k]
                            at = at[s[at] >= cut]
                            at = at[np.argsort(-s[at], kind="stable")[:k]]
                        for col, v in zip(out, ([int(me)] * len(at), [w] * len(at), rows[at].tolist(), [ids[j] for j in at], s[at].tolist())):
                            col.extend(v)
        return pa.table([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], ["a", "window", "row", "id", "score"])
    return run


def _pieces(left: DataFrame, right: DataFrame, on: Sequence[str], left_rows: int, right_rows: int, left_id: str, right_id: str):
    """Both sides dealt so that every row of one meets every row of the other with equal
    ``on`` in exactly one group of at most about ``left_rows`` and ``right_rows``."""
    size = (left.groupBy(*on).agg(F.ceil(F.count("*") / F.lit(left_rows)).cast("int").alias("ln"))
            .join(right.groupBy(*on).agg(F.ceil(F.count("*") / F.lit(right_rows)).cast("int").alias("rn")), on=list(on)))
    lt = (left.join(size, on=list(on)).withColumn("lp", F.expr(f"cast(pmod(xxhash64({left_id}), ln) AS int)"))
          .withColumn("rp", F.explode(F.expr("sequence(0, rn - 1)"))).drop("ln", "rn"))
    rt = (right.join(size, on=list(on)).withColumn("rp", F.expr(f"cast(pmod(xxhash64({right_id}), rn) AS int)"))
          .withColumn("lp", F.explode(F.expr("sequence(0, ln - 1)"))).drop("ln", "rn"))
    by = [*on, "lp", "rp"]
    return lt.groupBy(*by).cogroup(rt.groupBy(*by))


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("a", "window").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(blocks: DataFrame, anchors: DataFrame, same_label: bool, k: int, seeds: int = 2, name: str = "negatives") -> tuple[DataFrame, DataFrame]:
    """The best ``k`` rows of each window: ``(a, window, row, id, score, rank)``, and the
    blocks read, ``(a, block)``.  ``anchors``: ``a, label, width, vec, floor, top``."""
    zones = blocks.select("block", "label", "width", "low", "high")
    on = ["width", "label"] if same_label else ["width"]
    met = _pieces(zones, anchors, on, 1024, 2048, "block", "a").applyInArrow(_meet(same_label), "a long, block long, least long, most long")
    met = written(met, f"{name}-bounds")
    first = Window.partitionBy("a").orderBy(F.desc("most"), "block")
    early = met.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= seeds).select("a", "block")

    def read(pairs: DataFrame, at: DataFrame, what: str) -> DataFrame:
        asked = written(pairs.join(at.select("a", "vec", "floor", "top"), "a"), f"{name}-{what}-asked")
        got = _pieces(blocks.select("block", "width", "ids", "rows", "q"), asked, ["block"], 1, 4096, "block", "a")
        return written(got.applyInArrow(_reads(k), "a long, window int, row long, id long, score long"), f"{name}-{what}")

    early = written(early, f"{name}-seeds")
    one = read(early, anchors, "first")
    # a window's floor: the k-th best score found, where there are k
    full = _best(one, k).where(F.col("rank") == k).groupBy("a").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("got"))
    raised = F.transform("floor", lambda f, i: F.greatest(f, F.coalesce(F.try_element_at(F.col("got"), i), f)))
    at = written(anchors.join(full, "a", "left").withColumn("floor", raised).drop("got"), f"{name}-floors")
    rest = met.join(early, ["a", "block"], "left_anti").join(at.select("a", "floor", "top"), "a")
    rest = rest.where(F.exists(F.arrays_zip("floor", "top"), lambda z: (F.col("most") >= z["floor"]) & (F.col("least") <= z["top"]))).select("a", "block")
    rest = written(rest, f"{name}-rest")
    return _best(one.union(read(rest, at, "then")), k), early.union(rest)


def hard_negatives(vectors: DataFrame, anchor: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, grid: int = 256,
                   block_rows: int = 1024, bits: int = 4, seeds: int = 2) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``:
    for each anchor and each of its first ``positives`` rows of its label the first
    ``negatives`` rows of other labels with ``low`` to ``high`` percent of its score."""
    blocks = candidate_blocks(vectors, id_col, vector_col, label, anchor, grid, block_rows, bits)
    anchors = written(blocks.select("label", "width", "ids", "rows", "anchors", "q").mapInArrow(
        _anchors, "a long, anchor_id long, label string, width int, vec binary"), "negatives-anchors")
    whole = anchors.withColumns({"floor": F.array(F.lit(-OPEN)), "top": F.array(F.lit(OPEN))})
    good, _ = search(blocks, whole, same_label=True, k=positives, seeds=seeds, name="positives")
    good = written(good.select("a", (F.col("rank") - 1).alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives-best")
    # a window of each positive; none where its score is negative
    p = "positive_score"
    edge = F.struct("window", F.expr(f"IF({p} < 0, {OPEN}L, ({p} * {low} + 99) div 100)").alias("floor"), F.expr(f"IF({p} < 0, -{OPEN}L, ({p} * {high}) div 100)").alias("top"))
    edges = good.groupBy("a").agg(F.array_sort(F.collect_list(edge)).alias("edges"))      # at most `positives` of them
    asked = written(anchors.join(edges, "a").select("a", "label", "width", "vec", F.col("edges.floor").alias("floor"), F.col("edges.top").alias("top")), "negatives-windows")
    bad, _ = search(blocks, asked, same_label=False, k=negatives, seeds=seeds)
    out = bad.join(good, ["a", "window"]).join(anchors.select("a", "anchor_id"), "a")
    return out.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
