"""Embedding whitening: distributed centred covariance, leading components by
Householder, Sturm counts and inverse iteration, broadcast projection.

Vectors are put on an integer grid (``floor(grid * component)``), so counts, sums and
deviations are exact.  Each distinct grid vector is fitted on once.  Two passes over
those: exact sums per dimension, then each task adds up ``(x - mean)(x - mean)^T`` and
the rows of these matrices are added by row number.  What reaches the driver is the
``d x d`` covariance, whose size is that of the dimension and not of the table; there
it is brought to tridiagonal form by Householder reflections, its leading eigenvalues
are bisected by Sturm counts, and their vectors come from inverse iteration, orthogonal
to the earlier ones of a close cluster.  The ``k x d`` components are broadcast and each
row is projected where it lies.

Scale: the shuffles are the distinct grid vectors and one ``d x d`` matrix a task (3 %
of the input at 1,024 dimensions and 256 MB a task).  Copies of one vector collapse on
the way, so a hot vector weighs nothing; no group depends on a key of the data.

Defined cases: a row whose vector is null or empty, holds a null or non-finite entry or
one whose grid value does not fit (2**53 and beyond), or does not have the dimension most
rows have (of equally frequent ones the larger), is dropped; repeated ids and rows stay;
a null id stays null; with fewer dimensions than components there are as many components
as dimensions; a component without variance has ``whitened`` null and takes no part in
``identity_error``; ``explained`` is 0 where nothing varies; an empty table gives an empty
result; other columns are not read.  ``deviation`` is a decimal, as it outgrows a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import written

EPS = np.finfo(np.float64).eps
FIT = 2**53


def _grid(grid: int):
    """Rows ``(id, x)`` of sound vectors on the grid."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec = batch.column(1)
            width = np.where(np.asarray(vec.is_valid()), vec.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0).astype(np.int64)
            flat = vec.flatten()
            values = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
            with np.errstate(invalid="ignore", over="ignore"):
                x = np.floor(values * grid)
                bad = np.concatenate([[0], np.cumsum(~(np.abs(x) < FIT))])
            ends = np.cumsum(width)
            sound = (width > 0) & (bad[ends] == bad[ends - width])
            x = np.where(np.repeat(sound, width), x, 0)[np.repeat(sound, width)].astype(np.int64)
            offsets = np.concatenate([[0], np.cumsum(width[sound])]).astype(np.int32)
            ids = batch.column(0).filter(pa.array(sound))
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(offsets), pa.array(x)), pa.array(width[sound].astype(np.int32))],
                                             ["id", "x", "width"])
    return run


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors of one length as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _sums(width: int):
    """``(dimension, sum, number of rows)`` of a task's vectors, exact."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = [0] * width, 0
        for batch in batches:
            x = matrix(batch.column(0), width)
            for lo in range(0, len(x), 512):          # 512 values below 2**53 stay in 64 bits
                total = [a + b for a, b in zip(total, x[lo:lo + 512].sum(axis=0).tolist())]
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([str(t) for t in total]), pa.array([n] * width, pa.int64())],
                                             ["dim", "s", "n"])
    return run


def _scatter(mean: np.ndarray):
    """Rows of a task's sum of centred outer products."""
    width = len(mean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros((width, width)), False
        for batch in batches:
            x = matrix(batch.column(0), width)
            for lo in range(0, len(x), 4096):
                c = x[lo:lo + 4096] - mean
                total += c.T @ c
                some = True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["dim", "row"])
    return run


def _added(width: int):
    """Matrix rows added by row number, within a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, row in zip(batch.column(0).to_pylist(), matrix(batch.column(1), width)):
                total[d] = total[d] + row if d in total else row.copy()
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.list_(pa.float64()))], ["dim", "row"])
    return run


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Householder: diagonal and off-diagonal of ``q.T @ v @ q``, and ``q``."""
    a, n = v.copy(), len(v)
    q = np.eye(n)
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        norm = np.linalg.norm(x)
        if norm <= EPS * np.abs(a[k, k]) * EPS:
            continue
        x[0] += np.copysign(norm, x[0])
        u = x / np.linalg.norm(x)
        rest = a[k + 1:, k + 1:]
        p = rest @ u
        w = 2 * (p - (u @ p) * u)
        rest -= np.outer(u, w) + np.outer(w, u)
        a[k + 1:, k] = a[k, k + 1:] = 0
        a[k + 1, k] = a[k, k + 1] = -np.copysign(norm, x[0])
        q[:, k + 1:] -= 2 * np.outer(q[:, k + 1:] @ u, u)
    return np.diag(a).copy(), np.diag(a, -1).copy(), q


def sturm_count(d: np.ndarray, e: np.ndarray, shift: float, least: float) -> int:
    """Number of eigenvalues of the tridiagonal matrix below ``shift``."""
    count, p = 0, 1.0
    for i in range(len(d)):
        p = d[i] - shift - (e[i - 1] ** 2 / p if i else 0.0)
        if abs(p) < least:
            p = -least
        count += p < 0
    return count


def leading_eigenvalues(d: np.ndarray, e: np.ndarray, k: int) -> list[float]:
    """The ``k`` largest eigenvalues, falling, by bisection of Sturm counts."""
    reach = np.abs(np.concatenate([[0], e])) + np.abs(np.concatenate([e, [0]]))
    low, high = float((d - reach).min()), float((d + reach).max())
    norm = max(abs(low), abs(high), np.finfo(np.float64).tiny)
    least, n, out = EPS * EPS * norm, len(d), []
    dl, el = d.tolist(), e.tolist()
    for j in range(1, k + 1):
        a, b = low - EPS * norm, (out[-1] if out else high) + 2 * EPS * norm
        while b - a > 2 * EPS * max(abs(a), abs(b), EPS * norm):
            mid = (a + b) / 2
            if mid in (a, b):
                break
            if n - sturm_count(dl, el, mid, least) >= j:       # at least j eigenvalues from mid on
                a = mid
            else:
                b = mid
        out.append((a + b) / 2)
    return out


def _solve(d: np.ndarray, e: np.ndarray, shift: float, y: np.ndarray, least: float) -> np.ndarray:
    """``(T - shift) z = y`` by elimination with row exchanges (two upper diagonals)."""
    n = len(d)
    a, b, c = (d - shift).tolist(), e.tolist() + [0.0], [0.0] * n
    low, y = e.tolist(), y.tolist()
    for i in range(n - 1):
        if abs(low[i]) > abs(a[i]):
            a[i], low[i] = low[i], a[i]
            b[i], a[i + 1] = a[i + 1], b[i]
            c[i], b[i + 1] = b[i + 1], c[i]
            y[i], y[i + 1] = y[i + 1], y[i]
        pivot = a[i] if abs(a[i]) >= least else least
        a[i] = pivot
        m = low[i] / pivot
        a[i + 1] -= m * b[i]
        b[i + 1] -= m * c[i]
        y[i + 1] -= m * y[i]
    for i in range(n - 1, -1, -1):
        pivot = a[i] if abs(a[i]) >= least else least
        y[i] = (y[i] - (b[i] * y[i + 1] if i + 1 < n else 0.0) - (c[i] * y[i + 2] if i + 2 < n else 0.0)) / pivot
        top = abs(y[i])
        if top > 1e150:                               # the solution may grow without bound: scale it
            y = [v / top for v in y]
    return np.array(y)


def leading_components(v: np.ndarray, k: int, cluster: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and unit
    eigenvectors as rows.  Eigenvalues closer than ``cluster`` of the largest are one
    cluster: their vectors are made orthogonal to each other in every step.  The sign
    is that with which the largest entry is positive."""
    n = len(v)
    k = min(k, n)
    scale = np.abs(v).max() if n else 0.0
    if not scale > 0:
        return np.zeros(k), np.eye(n)[:k]
    d, e, q = tridiagonal(v / scale)
    values = leading_eigenvalues(d, e, k)
    norm = max(1.0, np.abs(d).max() + 2 * np.abs(e).max(initial=0.0))
    rng = np.random.default_rng(12)
    rows: list[np.ndarray] = []
    for j, value in enumerate(values):
        near = [rows[i] for i in range(j) if values[i] - value <= cluster * norm]
        z = rng.standard_normal(n)
        # equal eigenvalues are told apart by a few roundings of the shift
        shift = value - len([1 for i in range(j) if values[i] - value <= 4 * EPS * norm]) * 4 * EPS * norm
        for _ in range(6):
            z = _solve(d, e, shift, z / np.linalg.norm(z), EPS * EPS * norm)
            z /= np.abs(z).max()
            for r in near * 2:                        # twice: what the first pass leaves by cancellation goes
                z -= (r @ z) * r
        rows.append(z / np.linalg.norm(z))
    out = []
    for r in rows:
        c = q @ r
        for o in out * 2:
            c -= (o @ c) * o
        out.append(c / np.linalg.norm(c))
    c = np.array(out)
    c *= np.sign(c[np.arange(k), np.argmax(np.abs(c), axis=1)])[:, None]
    # the value of a component to double precision: its Rayleigh quotient
    return np.maximum(np.einsum("ij,jk,ik->i", c, v, c), 0.0), c


def _projected(mean: np.ndarray, comps: np.ndarray, scale: np.ndarray, n: int, sums: list[int], exact: bool):
    """``id, deviation, w`` of each row (columns id, x): the deviation as text, exact."""
    width = len(mean)
    s = np.array(sums, np.int64) if exact else np.array(sums, object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), width)
            w = (x - mean) @ comps.T * scale
            apart = (x if exact else x.astype(object)) * n - s
            dev = (apart * apart).sum(axis=1).tolist() if len(x) else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([str(v) for v in dev], pa.string()), pa.array(list(w), pa.list_(pa.float64()))],
                                             ["id", "deviation", "w"])
    return run


def _weights(mean: np.ndarray, comps: np.ndarray, scale: np.ndarray):
    """Whitened coordinates of the vectors in column x."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = (matrix(batch.column(0), len(mean)) - mean) @ comps.T * scale
            yield pa.RecordBatch.from_arrays([pa.array(w[:, i]) for i in range(w.shape[1])], [f"w{i}" for i in range(w.shape[1])])
    return run


def embedding_whitening(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                        components: int = 4, grid: int = 256) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error``: one row per
    sound vector and component."""
    spark = vectors.sparkSession
    schema = "id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    src = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("x"))
    rows = written(src.mapInArrow(_grid(grid), "id long, x array<long>, width int"), "whitening-grid")
    first = rows.groupBy("width").count().orderBy(F.desc("count"), F.desc("width")).first()
    if first is None:
        return spark.createDataFrame([], schema)
    width = first["width"]
    rows = rows.where(F.col("width") == width).select("id", "x")
    fit = written(rows.select("x").distinct(), "whitening-fit")
    parts = fit.mapInArrow(_sums(width), "dim int, s string, n long")
    total = parts.groupBy("dim").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).orderBy("dim").collect()    # one row a dimension
    sums, n = [int(r["s"]) for r in total], total[0]["n"]
    mean = np.array([s / n for s in sums])
    matrix_rows = fit.mapInArrow(_scatter(mean), "dim int, row array<double>").repartition("dim")
    v = np.zeros((width, width))
    for r in matrix_rows.mapInArrow(_added(width), "dim int, row array<double>").collect():      # one row a dimension
        v[r["dim"]] = r["row"]
    v = (v + v.T) / 2 / n
    values, comps = leading_components(v, components)
    trace = float(np.trace(v))
    sound = values > 64 * EPS * max(trace, 0.0)
    scale = np.where(sound, 1 / np.sqrt(np.where(sound, values, 1.0)), 0.0)
    explained = (values / trace if trace > 0 else np.zeros(len(values))).tolist()
    error = _identity_error(fit, mean, comps[sound], scale[sound])
    # deviations in 64 bits where the range of the grid proves that they fit
    top = rows.select(F.max(F.array_max("x")), F.min(F.array_min("x"))).first()
    apart = n * max(abs(top[0]), abs(top[1])) + max(abs(s) for s in sums)
    exact = width * apart * apart < 2**63
    found = rows.mapInArrow(_projected(mean, comps, scale, n, sums, exact), "id long, deviation string, w array<double>")
    of = F.array(*[F.struct(F.lit(i + 1).alias("component"), (F.col("w")[i] if ok else F.lit(None).cast("double")).alias("whitened"), F.lit(explained[i]).alias("explained"))
                   for i, ok in enumerate(sound.tolist())])
    out = found.select("id", F.col("deviation").cast("decimal(38,0)").alias("deviation"), F.explode(of).alias("c"))
    return out.select("id", "c.component", F.lit(n).cast("long").alias("n"), "deviation", "c.whitened", "c.explained",
                      F.lit(error).cast("double").alias("identity_error"))


def _identity_error(fit: DataFrame, mean: np.ndarray, comps: np.ndarray, scale: np.ndarray) -> float | None:
    """Largest entry of the whitened fit list's covariance minus the identity, computed
    from the list anew (the built-in covariance is centred); None without a component."""
    k = len(comps)
    if not k:
        return None
    white = fit.mapInArrow(_weights(mean, comps, scale), ", ".join(f"w{i} double" for i in range(k)))
    pairs: list[tuple[int, int]] = [(i, j) for i in range(k) for j in range(i + 1)]
    entry: list[Column] = [F.covar_pop(f"w{i}", f"w{j}") for i, j in pairs]
    got = white.agg(*[c.alias(f"c{n}") for n, c in enumerate(entry)]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(got, pairs))
