"""Embedding near-duplicates: spherical k-means cells, blocked cosine products.

Vectors are normalized in double precision and equal ones of a label collapse
first, so copies weigh nothing.  Spherical k-means, fitted per label on a bounded
sample, assigns every vector to its nearest centroid (its home cell).  A vector is
also a guest of each cell whose bounding hyperplane lies within ``margin`` of it,
so a pair that a cell border cuts still meets.  Two unit vectors with a cosine of
``min_cosine`` are at most ``sqrt(2 - 2 * min_cosine)`` apart, so with the default margin
of that much either of a linked pair is a guest of the other's home, whatever the cells
are: links and components are exact.  A smaller margin is faster and loses links.

Each vector is kept in one block, a run of cells of its label, and moved only to
the blocks that hold cells it is a guest of; of two blocks one moves its vectors to
the other, not both.  Blocks grow with the table, up to ``block_bytes``, so the number
of copies follows the number of blocks, not of cells.  A task holds one block, streams
what is moved to it and compares by matrix products; what leaves it are the number of
partners of each vector and a spanning forest of the links, never all pairs.  Vectors
travel as their own bytes (of a float column in single precision) and are normalized
where they are used.

Defined cases: a null label, a null, empty or zero vector, or one with a null or
non-finite component links with nothing and is kept; vectors of different
lengths never link; equal rows link with each other; repeated ids count as
separate vectors; a vector without id counts as a partner and joins no component; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwise.llm.common import connected_components, written

#: Vectors, and rows of a block, that one product compares.
SLICE, STRIPE = 1024, 2048


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Unit centroids of unit vectors by cosine."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), size=min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = np.argmax(x @ c.T, axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        norms = np.linalg.norm(sums, axis=1)
        c = np.where(norms[:, None] > 0, sums / np.maximum(norms, 1e-300)[:, None], c)
    return c


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows as unit vectors in double precision, the same whatever rows stand beside them;
    scaled by the largest component first, so that squares neither overflow nor vanish."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1)[:, None]
    squares = np.zeros(len(x))
    for c in x.T:
        squares += c * c
    x /= np.sqrt(squares)[:, None]
    x += 0.0        # no negative zero
    return x


def _raw(column: pa.Array, width: int, kind: str) -> np.ndarray:
    """Vectors of one length, kept as bytes, as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _groups(*columns: pa.Array) -> list[tuple[tuple, np.ndarray]]:
    """Row numbers of each combination of values."""
    by: dict = {}
    for i, g in enumerate(zip(*(c.to_pylist() for c in columns))):
        by.setdefault(g, []).append(i)
    return [(g, np.array(at)) for g, at in by.items()]


def _prepared(kind: str, share: float = 1.0, models: dict | None = None):
    """``id, label, width, digest, cell, vec`` of each vector; ``digest`` tells the unit
    vectors of a label apart, and is missing for rows that link with nothing.  ``share`` < 1
    keeps about that part of the digests; without ``models`` no vectors are kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, labels, vec = len(batch), batch.column(1).to_pylist(), batch.column(2)
            sizes = pc.fill_null(pc.list_value_length(vec), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            values = pc.fill_null(vec.flatten(), float("nan")).to_numpy(zero_copy_only=False).astype(kind)
            starts = np.cumsum(sizes) - sizes
            named = np.array([x is not None for x in labels], bool)
            digests, raw, cell = [None] * n, [None] * n, np.full(n, -1, np.int32)
            for width in np.unique(sizes[named & (sizes > 0)]).tolist():
                at = np.flatnonzero(named & (sizes == width))
                x = values[starts[at][:, None] + np.arange(width)]
                sound = np.isfinite(x).all(axis=1)
                sound[sound] = x[sound].any(axis=1)
                at, x = at[sound], x[sound]
                if not len(at):
                    continue
                unit = _unit(x)
                for i, row in zip(at.tolist(), unit):
                    text = labels[i].encode()
                    digests[i] = hashlib.blake2b(b"%d:%b" % (len(text), text) + row.tobytes(), digest_size=16).digest()
                if models is None:
                    continue
                for i, row in zip(at.tolist(), x):
                    raw[i] = row.tobytes()
                for label, some in _groups(pa.array([labels[i] for i in at.tolist()])):
                    c = models.get((label[0], width))
                    for lo in range(0, len(some) if c is not None else 0, SLICE):
                        part = some[lo:lo + SLICE]
                        cell[at[part]] = np.argmax(unit[part] @ c.T, axis=1)
            keep = np.arange(n) if share >= 1 and models is None else np.array(
                [i for i, d in enumerate(digests) if d is not None and int.from_bytes(d[:8], "big") < share * 2.0**64], np.int64)
            take = pa.array(keep)
            columns = [batch.column(0), batch.column(1), pa.array(sizes.astype(np.int32)), pa.array(digests, pa.binary()), pa.array(cell), pa.array(raw, pa.binary())]
            yield pa.RecordBatch.from_arrays([c.take(take) for c in columns], ["id", "label", "width", "digest", "cell", "vec"])
    return run


PREPARED = "id long, label string, width int, digest binary, cell int, vec binary"


def _guests(x: np.ndarray, c: np.ndarray, home: np.ndarray, margin: float) -> np.ndarray:
    """Which cells each vector has to meet: its home, and those it is a guest of."""
    who, s = np.arange(len(x)), x @ c.T
    out = s[who, home][:, None] - s <= margin * np.sqrt(np.maximum(0, 2 - 2 * (c[home] @ c.T)))
    out[who, home] = True
    return out


def _moves(own: np.ndarray, blocks: int) -> np.ndarray:
    """Of two blocks one moves its vectors to the other: which do those of ``own`` move to."""
    to = np.arange(blocks)[None, :] - own[:, None]
    return np.where(to > 0, to % 2 == 1, (to < 0) & (to % 2 == 0))


def _dealt(kind: str, models: dict, counts: dict, rows_of, margin: float):
    """Each vector in its own block, and in those it is moved to.  ``counts``: vectors of
    each cell of a label, ``rows_of`` a width: of a block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (label, width), at in _groups(batch.column(0), batch.column(1)):
                most, n = rows_of(width), counts.get((label, width), np.ones(1, np.int64))
                starts = np.cumsum(n) - n
                blocks = max(1, -(-int(n.sum()) // most))
                c = models.get((label, width))
                holds = (starts[:, None] // most <= np.arange(blocks)) & (np.arange(blocks) <= (starts + np.maximum(n, 1) - 1)[:, None] // most)
                for lo in range(0, len(at), SLICE):
                    part = batch.take(pa.array(at[lo:lo + SLICE]))
                    home = np.maximum(part.column(3).to_numpy(), 0)
                    within = np.array([int.from_bytes(d[:4], "big") for d in part.column(2).to_pylist()]) / 2**32
                    own = np.minimum((starts[home] + (within * n[home]).astype(np.int64)) // most, blocks - 1)
                    if c is None or blocks == 1:
                        meets = np.ones((len(part), blocks), bool)
                    else:
                        meets = _guests(_unit(_raw(part.column(6), width, kind)), c, home, margin).astype(np.float32) @ holds.astype(np.float32) > 0
                    meets &= _moves(own, blocks)
                    meets[np.arange(len(part)), own] = True
                    who, block = np.nonzero(meets)
                    for i in range(0, len(who), 4 * SLICE):
                        some, to = who[i:i + 4 * SLICE], block[i:i + 4 * SLICE]
                        out = part.take(pa.array(some))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([f"{label}/{width}/{b}" for b in to.tolist()]), pa.array(own[some] != to), *(out.column(j) for j in range(2, 7))],
                            ["key", "moved", "digest", "cell", "id", "copies", "vec"])
    return run


class _Block:
    """The vectors of one block, in the order of their cells."""

    def __init__(self, key: str, held: list[pa.RecordBatch], kind: str, models: dict, margin: float, min_cosine: float):
        label, width, _ = key.rsplit("/", 2)
        self.width, self.kind, self.margin, self.least = int(width), kind, margin, min_cosine
        self.c = models.get((label, self.width))
        cell = np.concatenate([h.column(3).to_numpy() for h in held])
        order = np.argsort(cell, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.raw = np.empty((len(order), self.width), kind)
        self.unit = np.empty((len(order), self.width), np.float32)
        lo = 0
        for h in held:
            x, at = _raw(h.column(6), self.width, kind), place[lo:lo + len(h)]
            self.raw[at], self.unit[at] = x, _unit(x)
            lo += len(h)
        table = pa.Table.from_batches(held).select(["digest", "id", "copies"]).take(pa.array(order))
        self.digest, self.cell, self.copies = table.column(0).combine_chunks(), cell[order], table.column(2).to_numpy()
        self.id, self.named = _ids(table.column(1))
        cells, first = np.unique(self.cell, return_index=True)
        self.runs = list(zip(cells.tolist(), first.tolist(), [*first[1:].tolist(), len(order)]))
        self.root, self.partners = np.arange(len(order)), np.zeros(len(order), np.int64)
        # what single precision leaves open is compared again in double precision
        self.slack = (self.width + 8) * 2.0**-23

    def _root(self, i: np.ndarray) -> np.ndarray:
        r = self.root[i]
        while (further := self.root[r] != r).any():
            r = np.where(further, self.root[r], r)
        self.root[i] = r
        return r

    def _unite(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self._root(a), self._root(b)
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))

    def _near(self, raw: np.ndarray, some: np.ndarray, unit: np.ndarray, lo: int, hi: int, after: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Linked pairs (row of ``raw``, row of the block) of ``some`` rows with ``lo`` to ``hi``."""
        s = unit @ self.unit[lo:hi].T
        maybe = s >= self.least - self.slack
        if after is not None:
            maybe &= after[:, None] < np.arange(lo, hi)
        i, j = np.nonzero(maybe)
        open_ = np.flatnonzero(s[i, j] < self.least + self.slack)
        i, j, sure = some[i], j + lo, np.ones(len(i), bool)
        for k in range(0, len(open_), SLICE):
            at = open_[k:k + SLICE]
            sure[at] = np.einsum("nd,nd->n", _unit(raw[i[at]]), _unit(self.raw[j[at]])) >= self.least
        return i[sure], j[sure]

    def within(self) -> None:
        """Pairs within the block."""
        for h, (cell, lo, hi) in enumerate(self.runs):
            for at in range(lo, hi, SLICE):
                rows = np.arange(at, min(at + SLICE, hi))
                for i, j in self._compared(self.raw[rows], self.unit[rows], np.full(len(rows), cell), self.copies[rows], self.runs[h:], rows):
                    self.partners[rows] += np.bincount(i, weights=self.copies[j], minlength=len(rows)).astype(np.int64)
                    linked = self.named[rows[i]] & self.named[j]
                    self._joined(i[linked], rows[i[linked]], j[linked])

    def _compared(self, raw, unit, home, copies, runs, after=None):
        """Linked pairs with the cells ``runs``; the partners of the block's rows are counted here."""
        guests = None if self.c is None else _guests(_unit(raw), self.c, home, self.margin)
        for cell, lo, hi in runs:
            some = np.arange(len(raw)) if guests is None else np.flatnonzero(guests[:, cell])
            if not len(some):
                continue
            x = unit[some]
            own = after is not None and lo <= after[0] < hi
            for b in range(lo, hi, STRIPE):
                e = min(b + STRIPE, hi)
                if own and e <= after[0]:
                    continue
                i, j = self._near(raw, some, x, b, e, after[some] if own else None)
                if len(i):
                    self.partners[b:e] += np.bincount(j - b, weights=copies[i], minlength=e - b).astype(np.int64)
                    yield i, j

    def _joined(self, group: np.ndarray, x: np.ndarray | None, j: np.ndarray) -> None:
        """One component holds all partners of a vector (``group``, ascending), and itself if
        it is of the block (``x``): each is joined to the first, so copies of one text cost
        as many unions as there are of them, not as there are pairs."""
        if len(group):
            at, first = np.unique(group, return_index=True)
            lead = j[first][np.searchsorted(at, group)]
            self._unite(lead, j)
            if x is not None:
                self._unite(x[first], j[first])

    def met(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Pairs with vectors moved to the block."""
        for lo in range(0, len(batch), SLICE):
            part = batch.slice(lo, SLICE)
            raw, copies, (ids, named) = _raw(part.column(6), self.width, self.kind), part.column(5).to_numpy(), _ids(part.column(4))
            n, to = np.zeros(len(part), np.int64), np.full(len(part), -1)
            for i, j in self._compared(raw, _unit(raw).astype(np.float32), np.maximum(part.column(3).to_numpy(), 0), copies, self.runs):
                n += np.bincount(i, weights=self.copies[j], minlength=len(part)).astype(np.int64)
                linked = named[i] & self.named[j]
                i, j = i[linked], j[linked]
                self._joined(i, None, j)
                at, first = np.unique(i, return_index=True)
                old = to[at] >= 0
                self._unite(to[at[old]], j[first[old]])
                to[at] = j[first]
            got = np.flatnonzero(n)
            yield _found(part.column(2).take(pa.array(got)), n[got], ids[to >= 0], self.id[to[to >= 0]])

    def done(self) -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(self.id), 4 * SLICE):
            at = np.arange(lo, min(lo + 4 * SLICE, len(self.id)))
            root, got = self._root(at), lo + np.flatnonzero(self.partners[at])
            yield _found(self.digest.take(pa.array(got)), self.partners[got], self.id[at[root != at]], self.id[root[root != at]])


def _ids(column) -> tuple[np.ndarray, np.ndarray]:
    return np.asarray(pc.fill_null(column, 0)), np.asarray(pc.is_valid(column))


def _found(digest, n, a, b) -> pa.RecordBatch:
    """Numbers of partners by digest, and links between ids."""
    none, nil = pa.nulls(len(a), pa.binary()), pa.nulls(len(n), pa.int64())
    return pa.RecordBatch.from_arrays([pa.concat_arrays(x) for x in (
        [digest.cast(pa.binary()), none], [pa.array(n), pa.nulls(len(a), pa.int64())], [nil, pa.array(a)], [nil, pa.array(b)])], ["digest", "n", "a", "b"])


def _links(kind: str, models: dict, margin: float, min_cosine: float):
    """One block at a time: its own vectors come first, then those moved to it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, block = None, [], None

        def built():
            made = _Block(key, held, kind, models, margin, min_cosine)
            held.clear()
            made.within()
            return made

        for batch in batches:
            keys, moved = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            cuts = [0] + [i for i in range(1, len(keys)) if keys[i] != keys[i - 1] or moved[i] != moved[i - 1]] + [len(keys)]
            for s, e in zip(cuts, cuts[1:]):
                if s == e:
                    continue
                if keys[s] != key:
                    block = block or (built() if held else None)
                    if block:
                        yield from block.done()
                    key, block = keys[s], None
                if not moved[s]:
                    held.append(batch.slice(s, e - s))
                    continue
                block = block or (built() if held else None)
                if block:       # a block without vectors of its own links with none
                    yield from block.met(batch.slice(s, e - s))
        block = block or (built() if held else None)
        if block:
            yield from block.done()
    return run


def embedding_near_dedup(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                         min_cosine: float = 0.98, cell_rows: int = 2048, sample_rows: int = 20_000,
                         max_cells: int = 4096, margin: float | None = None, block_rows: int = 4096, block_bytes: int = 64 << 20) -> DataFrame:
    """``id, n_links, component_id, kept``, one row per vector.

    ``sample_rows`` bounds the vectors that k-means is fitted on (over all
    labels); every vector is indexed.  ``margin`` defaults to the chord of
    ``min_cosine``, which is exact (and a little more, for rounding).  A block has
    ``block_rows`` vectors or a sixteenth of all, whichever is more, up to ``block_bytes``.
    """
    chord = (2 - 2 * min_cosine) ** 0.5
    margin = chord * (1 + 1e-9) + 1e-9 if margin is None else margin
    spark, vector = vectors.sparkSession, F.col(vector_col)
    single = isinstance(getattr(vectors.select(vector).schema[0].dataType, "elementType", None), T.FloatType)
    kind = "<f4" if single else "<f8"
    given = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                           (vector if single else F.transform(vector, lambda x: x.cast("double"))).alias("vec"))
    rows = written(given.mapInArrow(_prepared(kind), PREPARED).select("id", "label", F.when(F.col("digest").isNotNull(), F.col("width")).alias("width"), "digest"), "embedding-rows")
    per_label = written(rows.where("digest IS NOT NULL").select("label", "width", "digest").distinct().groupBy("label", "width").agg(F.count("*").alias("n")), "embedding-labels")
    sizes = {(r["label"], r["width"]): r["n"] for r in per_label.orderBy(F.desc("n"), "label", "width").limit(sample_rows).collect()}
    total, values = (x or 0 for x in per_label.agg(F.sum("n"), F.sum(F.col("n") * F.col("width"))).first())
    models = {}
    if any(n > cell_rows for n in sizes.values()):
        share = min(1.0, sample_rows / total)
        picked = (given.mapInArrow(_prepared(kind, share, {}), PREPARED).groupBy("digest").agg(*[F.first(x).alias(x) for x in ("label", "width", "vec")])
                  .limit(2 * sample_rows).collect())
        sample: dict = {}
        for r in sorted(picked, key=lambda r: r["digest"]):
            sample.setdefault((r["label"], r["width"]), []).append(bytes(r["vec"]))
        for (label, width), xs in sample.items():
            k = min(max_cells, -(-sizes.get((label, width), 0) // cell_rows), max(1, len(xs) // 4))
            if k > 1:
                models[(label, width)] = spherical_kmeans(_unit(np.frombuffer(b"".join(xs), kind).reshape(-1, width)), k)
    # equal vectors of a label collapse to one
    firsts = written(given.mapInArrow(_prepared(kind, 1.0, models), PREPARED).groupBy("digest").agg(
        *[F.first(x).alias(x) for x in ("label", "width", "cell")], F.min("id").alias("id"), F.count("*").alias("copies"), F.first("vec").alias("vec"))
        .select("label", "width", "digest", "cell", "id", "copies", "vec"), "embedding-first")
    counts = {g: np.array([n]) for g, n in sizes.items()} | {g: np.zeros(len(c), np.int64) for g, c in models.items()}
    for r in firsts.where("cell >= 0").groupBy("label", "width", "cell").agg(F.count("*").alias("n")).collect():
        counts[(r["label"], r["width"])][r["cell"]] = r["n"]
    least, size = max(block_rows, -(-total // 16)), np.dtype(kind).itemsize

    def rows_of(width: int) -> int:
        return max(1, min(least, block_bytes // (width * size)))

    tasks = 2 * max(spark.sparkContext.defaultParallelism, -(-total // least), -(-values * size // block_bytes))
    dealt = firsts.mapInArrow(_dealt(kind, models, counts, rows_of, margin), "key string, moved boolean, digest binary, cell int, id long, copies long, vec binary")
    found = written(dealt.repartition(tasks, "key").sortWithinPartitions("key", "moved").mapInArrow(_links(kind, models, margin, min_cosine), "digest binary, n long, a long, b long"), "embedding-links")
    partners = found.where("digest IS NOT NULL").groupBy("digest").agg(F.sum("n").alias("n"))
    comp = connected_components(found.where("a IS NOT NULL").select("a", "b"), "embedding-cc")
    classes = (firsts.select("digest", "id", "copies").join(partners, "digest", "left").join(comp.withColumnRenamed("node", "id"), "id", "left")
               .select("digest", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id")))
    out = rows.select("id", "digest").join(classes, "digest", "left")
    return out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"),
                      F.coalesce(F.col("component_id") == F.col("id"), F.lit(True)).alias("kept"))
