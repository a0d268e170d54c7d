"""Toxicity severity by cumulative-link (proportional-odds) ordinal regression.

Grades come from the labels: 0 not toxic, 1 toxic in an otherwise good document,
2 toxic in a poor one.  Sparse features are the document's distinct words, hashed
to a fixed number of places; a chi-square test against the labels selects the
words that speak for toxicity, and only these get a weight.  One weight vector serves all ordered thresholds,
``P(grade <= k) = sigmoid(threshold_k - w.x)``, and the output is the expected
grade ``sum_k P(grade > k)``.  The cut for the ``toxic`` verdict is chosen on a
held-out quarter of the sample.

The fit uses a bounded sample of labelled documents (``sample_docs``); scoring
covers every document and the whole text.

Defined cases: a null or empty text, or one without words, has no feature and
gets severity 0; documents without labels are scored all the same; without any
labelled toxic document every severity is 0; repeated rows have equal results;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import row_slices, sampled, small_batches, utf8

BUCKETS = 1 << 22
GRADES = 3
_WORD = np.zeros(256, np.uint8)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15


def word_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, bucket)`` of each word (letters, digits and non-ASCII bytes, ASCII
    case folded); the hash of a word is a polynomial in its bytes."""
    inside = _WORD[data]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return start, start
    size = end - start
    at = np.flatnonzero(inside)
    place = at - np.repeat(start, size)
    powers = np.ones(int(place.max()) + 2, np.uint64)
    powers[1:] = np.uint64(_BASE)
    powers = np.multiply.accumulate(powers)
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    h = np.add.reduceat((_LOWER[data[at]] + np.uint64(1)) * powers[place], first)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    row = np.searchsorted(offsets, start, side="right") - 1
    return row, (h >> np.uint64(64 - (BUCKETS.bit_length() - 1))).astype(np.int64)


def features(data: np.ndarray, offsets: np.ndarray, used: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``(row, bucket)``: the distinct features of each row (offsets start at 0),
    of those that ``used`` marks."""
    row, bucket = word_buckets(data, offsets)
    if used is not None:
        kept = used[bucket]
        row, bucket = row[kept], bucket[kept]
    pairs = np.unique(row * BUCKETS + bucket)
    return pairs // BUCKETS, pairs % BUCKETS


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts with a line end after each, and their offsets."""
    offsets = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts]))).astype(np.int64)
    return np.frombuffer(b"\n".join([*texts, b""]), np.uint8), offsets


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def select_features(texts: list[bytes], toxic: np.ndarray, min_chi2: float, min_docs: int) -> np.ndarray:
    """Log odds ratio of the buckets that are more frequent in toxic documents
    than chance allows, 0 for all others."""
    a, c = np.zeros(BUCKETS), np.zeros(BUCKETS)
    data, offsets = _joined(texts)
    for i, j in row_slices(offsets, 1 << 20):
        rows, buckets = features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        of = toxic[i:j][rows]
        a += np.bincount(buckets[of], minlength=BUCKETS)
        c += np.bincount(buckets[~of], minlength=BUCKETS)
    n, t = float(len(toxic)), float(toxic.sum())
    b, d = t - a, n - t - c
    chi2 = n * (a * d - b * c) ** 2 / np.maximum((a + b) * (c + d) * (a + c) * (b + d), 1)
    odds = np.log((a + 0.5) / (b + 0.5)) - np.log((c + 0.5) / (d + 0.5))
    return np.where((chi2 >= min_chi2) & (a + c >= min_docs) & (odds > 0), odds, 0.0)


def fit_ordinal(rows: np.ndarray, buckets: np.ndarray, grades: np.ndarray, start: np.ndarray, rounds: int = 300,
                rate: float = 0.1, l1: float = 1e-4, balance: bool = False) -> dict:
    """Penalized maximum likelihood of the cumulative-link model by Adagrad over
    the whole sample, from the weights ``start`` on; thresholds stay in order as a
    first value and positive steps."""
    n = len(grades)
    used, col = np.unique(buckets, return_inverse=True)
    w, bias = start[used], np.zeros(GRADES - 1)
    gw2, gb2 = np.full(len(used), 1e-8), np.full(GRADES - 1, 1e-8)
    counts = np.bincount(grades, minlength=GRADES)
    weight = (n / np.maximum(counts, 1))[grades] if balance else np.ones(n)
    weight = weight / weight.sum()
    share = np.cumsum(counts)[:-1] / max(n, 1)
    share = np.clip(np.cumsum(np.full(GRADES, 1 / GRADES))[:-1] if balance else share, 1e-3, 1 - 1e-3)
    first = np.log(share / (1 - share))
    bias[0], bias[1:] = first[0], np.log(np.maximum(np.diff(first), 1e-2))

    def cuts(b):
        return b[0] + np.concatenate(([0.0], np.cumsum(np.exp(b[1:]))))
    for _ in range(rounds):
        z = np.bincount(rows, weights=w[col], minlength=n)
        below = _sigmoid(np.concatenate([cuts(bias), [1e9]])[None, :] - z[:, None])
        below[:, -1] = 1.0
        upper = below[np.arange(n), grades]
        lower = np.where(grades > 0, below[np.arange(n), np.maximum(grades - 1, 0)], 0.0)
        p = np.maximum(upper - lower, 1e-12)
        du, dl = upper * (1 - upper), lower * (1 - lower)
        gz = weight * (du - dl) / p                      # of the negative log likelihood, by z
        gw = np.bincount(col, weights=gz[rows], minlength=len(used))
        gc = np.zeros(GRADES - 1)
        for k in range(GRADES - 1):
            gc[k] = -(weight * (np.where(grades == k, du, 0) - np.where(grades == k + 1, dl, 0)) / p).sum()
        gb = np.concatenate(([gc.sum()], np.cumsum(gc[::-1])[::-1][1:] * np.exp(bias[1:])))
        gw2, gb2 = gw2 + gw * gw, gb2 + gb * gb
        step = rate / np.sqrt(gw2)
        w = w - step * gw
        w = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0)
        bias = bias - 0.1 * rate * gb / np.sqrt(gb2)
    return {"used": used[w != 0], "weights": w[w != 0], "cuts": cuts(bias)}


def _table(model: dict) -> np.ndarray:
    if "table" not in model:
        model["table"] = np.zeros(BUCKETS, np.float32)
        model["table"][model["used"]] = model["weights"]
    return model["table"]


def severity(model: dict, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``(expected grade, probabilities of each grade)`` of each text."""
    z = np.zeros(len(texts))
    some = np.fromiter((len(t) > 0 for t in texts), bool, len(texts))
    data, offsets = _joined(texts)
    weights = _table(model)
    used = weights != 0
    for i, j in row_slices(offsets, 2 << 20):
        rows, buckets = features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], used)
        z[i:j] = np.bincount(rows, weights=weights[buckets], minlength=j - i)
    below = _sigmoid(model["cuts"][None, :] - z[:, None])
    below = np.where(some[:, None], below, 1.0)
    p = np.diff(np.concatenate([np.zeros((len(z), 1)), below, np.ones((len(z), 1))], axis=1), axis=1)
    return (1 - below).sum(axis=1), p


def train(samples: list[tuple[bytes, int]], min_chi2: float = 8.0, min_docs: int = 3) -> dict:
    """Model and calibrated cut of ``(text, grade)`` samples."""
    none = {"used": np.zeros(0, np.int64), "weights": np.zeros(0), "cuts": np.full(GRADES - 1, 1e9), "cut": 1.0}
    grades = np.array([g for _, g in samples], np.int64)
    if not (grades > 0).any() or not (grades == 0).any():
        return none
    held = np.arange(len(samples)) % 4 == 3
    own = [t for (t, _), h in zip(samples, held) if not h]
    odds = select_features(own, grades[~held] > 0, min_chi2, min_docs)
    data, offsets = _joined(own)
    parts = [(i, *features(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], odds != 0)) for i, j in row_slices(offsets, 1 << 20)]
    model = fit_ordinal(np.concatenate([i + r for i, r, _ in parts]), np.concatenate([b for _, _, b in parts]), grades[~held], odds)
    value, _ = severity(model, [t for (t, _), h in zip(samples, held) if h])
    toxic = grades[held] > 0
    # best F1 on the held-out quarter, in the middle of the gap it falls in
    order = np.argsort(-value)
    hits = np.cumsum(toxic[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + max(1, toxic.sum())) if len(order) else np.zeros(0)
    if len(f1) and hits[-1]:
        k = int(f1.argmax())
        after = value[order[k + 1]] if k + 1 < len(order) else 0.0
        return {**model, "cut": float((value[order[k]] + after) / 2)}
    return {**model, "cut": 1.0}


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = 4000) -> dict:
    """Model from about ``sample_docs`` labelled documents, toxic ones up to half."""
    small_batches(docs.sparkSession)
    marks = (labels.select(F.col(id_col).alias("id"), F.col("toxic").cast("int").alias("toxic"), F.col("quality").cast("int").alias("quality"))
             .where("id IS NOT NULL AND toxic IN (0, 1)")
             .groupBy("id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
             .withColumn("grade", F.expr("CASE WHEN toxic = 0 THEN 0 WHEN quality = 0 THEN 2 ELSE 1 END")))
    sizes = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    within = F.lit(False)
    for toxic, n in sizes.items():
        share = min(1.0, sample_docs / 2 / n)
        within = within | ((F.col("toxic") == toxic) & sampled(share, "id"))
    picked = marks.where(within).select("id", "grade").limit(2 * sample_docs)       # bounded: broadcast
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    rows = src.join(F.broadcast(picked), "id").select("id", "text", "grade").limit(2 * sample_docs).collect()
    rows.sort(key=lambda r: (r["id"], r["text"]))
    return train([(r["text"].encode("utf-8", "replace"), r["grade"]) for r in rows])


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            data, offsets, _ = utf8(batch.column(1))
            raw = memoryview(data)
            value, p = severity(model, [bytes(raw[s:e]) for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist())])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(value), pa.array(p.argmax(axis=1).astype(np.int32)), pa.array(value >= model["cut"])],
                ["id", "severity", "grade", "toxic"])
    return run


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, severity, grade, toxic)``: expected grade, likeliest grade, verdict."""
    shared = docs.sparkSession.sparkContext.broadcast(model)        # the selected weights only
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(_score(shared), "id long, severity double, grade int, toxic boolean")
