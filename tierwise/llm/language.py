"""Language identification: script ranges, then Viterbi over per-word scores.

Each word (a run of letters and marks) gets a log score per language from hashed
character n-grams of order 2 to 4.  The script of its first letter narrows the
candidates to the languages that use it in training.  Viterbi with a penalty for
every switch labels each word, so a mixed text splits into spans; the language
with most letters is the prediction and its share of the letters the score.

The model is fitted on a bounded sample (``sample_docs`` whole documents, spread
evenly over the languages, at least ``LEAST_SAMPLES`` of each that has them) of the
labelled rows and learns every label.  Its tables have ``BUCKETS`` buckets per
language; beyond ``max_langs`` languages that number is halved until all tables
together are no larger, which bounds what is broadcast.  More than
``FOLDS * max_langs`` labels are refused.

Defined cases: a null or empty text, or one without a letter, is ``und`` with
score 0; without any labelled row every text is; equal texts have equal results;
ties go to the first language in order; the whole text counts at any length; an
empty table gives an empty result; columns other than the three named are not read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import row_slices, small_batches, utf8

UNKNOWN = "und"
BUCKETS = 1 << 17
LEAST_SAMPLES = 40
FOLDS = 16
#: First and last code point of the blocks of each script.
SCRIPTS = {
    "latin": [(0x0041, 0x005A), (0x0061, 0x007A), (0x00AA, 0x00AA), (0x00BA, 0x00BA), (0x00C0, 0x024F), (0x1E00, 0x1EFF)],
    "greek": [(0x0370, 0x03FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x0400, 0x052F)],
    "armenian": [(0x0530, 0x058F)],
    "hebrew": [(0x0590, 0x05FF)],
    "arabic": [(0x0600, 0x06FF), (0x0750, 0x077F)],
    "devanagari": [(0x0900, 0x097F)],
    "bengali": [(0x0980, 0x09FF)],
    "tamil": [(0x0B80, 0x0BFF)],
    "thai": [(0x0E00, 0x0E7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "kana": [(0x3040, 0x30FF)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF)],
}
_TABLES: list = []


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per code point below 2**16: lower-case form, kind (1 letter, 2 mark), script."""
    if not _TABLES:
        lower, kind, script = np.arange(65536, dtype=np.uint32), np.zeros(65536, np.uint8), np.zeros(65536, np.uint8)
        for c in range(65536):
            ch = chr(c)
            if ch.isalpha():
                kind[c] = 1
                low = ch.lower()
                if len(low) == 1:
                    lower[c] = ord(low)
            elif unicodedata.category(ch)[0] == "M":
                kind[c] = 2
        for n, blocks in enumerate(SCRIPTS.values(), 1):
            for lo, hi in blocks:
                script[lo:hi + 1] = n
        _TABLES.append((lower, kind, script))
    return _TABLES[0]


def _grams(text: np.ndarray) -> tuple[np.ndarray, ...]:
    """Words of one array of code points (texts parted by line ends):
    ``(start, end, script, letters, offsets of the words' n-grams, buckets)``."""
    lower, kind, script = _tables()
    low = np.minimum(text, 65535)
    kinds = kind[low]
    beyond = np.flatnonzero(text > 65535)
    for i in beyond.tolist():
        ch = chr(text[i])
        kinds[i] = 1 if ch.isalpha() else 2 if unicodedata.category(ch)[0] == "M" else 0
    at = np.flatnonzero(kinds)
    none = np.zeros(0, np.int64)
    if not len(at):
        return none, none, none, none, none, np.zeros((3, 0), np.int64)
    c = np.zeros(len(text) + 3, np.uint64)
    c[2:-1][at] = lower[low[at]]
    c[2:-1][beyond] = np.where(kinds[beyond] > 0, text[beyond], 0)
    first = np.flatnonzero(np.diff(at, prepend=at[0] - 2) > 1)
    start, end = at[first], at[np.append(first[1:], len(at)) - 1] + 1
    at = at + 2
    here, after, before = c[at], c[at + 1], c[at - 1]
    earlier = np.where(before > 0, c[at - 2], 0)
    shift = np.uint64(64 - (BUCKETS.bit_length() - 1))
    two = (here * np.uint64(0x9E3779B97F4A7C15)) ^ (after * np.uint64(0xC2B2AE3D27D4EB4F))
    three = two * np.uint64(0xFF51AFD7ED558CCD) ^ (before * np.uint64(0x165667B19E3779F9))
    four = three * np.uint64(0xC4CEB9FE1A85EC53) ^ (earlier * np.uint64(0x27D4EB2F165667C5))
    final = np.uint64(0xD6E8FEB86659FD93)
    buckets = np.stack([((h ^ (h >> np.uint64(29))) * final >> shift).astype(np.int64) for h in (two, three, four)])
    letters = np.add.reduceat((kinds[at - 2] == 1).astype(np.int64), first)
    return start, end, script[low[start]], letters, first, buckets


def train(samples: list[tuple[str, str]], alpha: float = 0.5, max_langs: int = 200) -> dict:
    """Model of ``(language, text)`` samples: n-gram log scores and scripts."""
    texts: dict = {}
    for lang, text in samples:
        texts.setdefault(lang, []).append(text)
    langs = sorted(texts)
    fold = (-(-len(langs) // max_langs) - 1).bit_length() if langs else 0
    size = BUCKETS >> fold
    tables = np.zeros((3, size, len(langs)), np.float32)
    used = np.zeros((len(SCRIPTS) + 1, len(langs)))
    for k, lang in enumerate(langs):
        counts = np.zeros((3, size))
        for text in texts[lang]:
            _, _, script, letters, _, buckets = _grams(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32))
            for n in range(3):
                counts[n] += np.bincount(buckets[n] >> fold, minlength=size)
            used[:, k] += np.bincount(script, weights=letters, minlength=len(used))
        total = counts.sum(axis=1, keepdims=True)
        tables[:, :, k] = np.log((counts + alpha) / (total + alpha * size / 8))
    share = used / np.maximum(used.sum(axis=0), 1)
    narrow = np.where(share >= 0.01, 0.0, -1e5)
    narrow[(share < 0.01).all(axis=1)] = 0.0
    return {"langs": langs, "tables": tables, "narrow": narrow.astype(np.float32), "fold": fold}


def viterbi(scores: np.ndarray, offsets: np.ndarray, penalty: float) -> np.ndarray:
    """Label of each word: the path of best score in each text (rows ``offsets[i]``
    to ``offsets[i + 1]``), a change of label costing ``penalty``.  All texts step
    together, the longest first, so a step is one array operation."""
    size = np.diff(offsets)
    order = np.argsort(-size, kind="stable")
    order = order[size[order] > 0]
    start, size = offsets[:-1][order], size[order]
    n, k = scores.shape
    back = np.zeros((n, k), np.int8 if k < 128 else np.int16)
    label = np.zeros(n, np.int64)
    if not len(order):
        return label
    own = np.arange(k, dtype=back.dtype)
    active = np.searchsorted(-size, -np.arange(size[0]), side="left")   # texts longer than t
    v = scores[start].copy()
    for t in range(1, int(size[0])):
        m = active[t]
        v_m = v[:m]
        top = v_m.argmax(axis=1)
        best = v_m[np.arange(m), top] - penalty
        stay = v_m >= best[:, None]
        at = start[:m] + t
        back[at] = np.where(stay, own, top[:, None].astype(back.dtype))
        v[:m] = np.maximum(v_m, best[:, None]) + scores[at]
    label[start + size - 1] = v.argmax(axis=1)
    for t in range(int(size[0]) - 1, 0, -1):
        at = start[:active[t]] + t
        label[at - 1] = back[at, label[at]]
    return label


def classify(texts: list[str], model: dict, penalty: float) -> tuple[list, list, list]:
    """``(language, score, spans)`` of each text; a span is ``language:start:end``."""
    langs, tables, narrow = model["langs"], model["tables"], model["narrow"]
    k = len(langs)
    scores, starts, ends, letters, docs = [], [], [], [], []
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    at = np.concatenate(([0], np.cumsum(lengths)))
    for i, j in row_slices(at, 1 << 18):
        start, end, script, count, first, buckets = _grams(np.frombuffer("\n".join(texts[i:j]).encode("utf-32-le", "surrogatepass"), np.uint32))
        if not len(start) or not k:
            continue
        buckets >>= model["fold"]
        gram = tables[0][buckets[0]]
        gram += tables[1][buckets[1]]
        gram += tables[2][buckets[2]]
        scores.append(np.add.reduceat(gram, first, axis=0) + narrow[script])
        doc = np.searchsorted(at[i:j + 1] - at[i], start, side="right") - 1 + i
        base = at[doc] - at[i]
        starts.append(start - base)
        ends.append(end - base)
        letters.append(count)
        docs.append(doc)
    n = len(texts)
    if not scores:
        return [UNKNOWN] * n, [0.0] * n, [""] * n
    scores, starts, ends, letters, docs = (np.concatenate(x) for x in (scores, starts, ends, letters, docs))
    offsets = np.searchsorted(docs, np.arange(n + 1))
    label = viterbi(scores, offsets, penalty)
    totals = np.bincount(docs * k + label, weights=letters, minlength=n * k).reshape(n, k)
    best, every = totals.argmax(axis=1), totals.sum(axis=1)
    new = np.flatnonzero((np.diff(docs, prepend=-1) != 0) | (np.diff(label, prepend=-1) != 0))
    last = np.append(new[1:], len(docs)) - 1
    spans: list = [[] for _ in range(n)]
    for d, x, s, e in zip(docs[new].tolist(), label[new].tolist(), starts[new].tolist(), ends[last].tolist()):
        spans[d].append(f"{langs[x]}:{s}:{e}")
    found = every > 0
    return ([langs[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), found.tolist())],
            np.where(found, totals[np.arange(n), best] / np.maximum(every, 1), 0.0).tolist(),
            [",".join(s) if ok else "" for s, ok in zip(spans, found.tolist())])


def _slice_bytes(model: dict) -> int:
    """Text at a time, less for many languages: there is a score per word and language."""
    return (16 << 20) * 8 // max(8, len(model["langs"]))


def _identify(shared, penalty: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets, _ = utf8(batch.column(1))
            for i, j in row_slices(offsets, _slice_bytes(shared.value)):
                part = batch.slice(i, j - i)
                lang, score, spans = classify([t or "" for t in part.column(1).to_pylist()], shared.value, penalty)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(spans, pa.string())], ["id", "lang_pred", "score", "spans"])
    return run


def held_out(id_col: str = "doc_id"):
    """The fold that training never sees: crc32 of the id as text, remainder 2 of 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample_docs: int = 4000, max_langs: int = 200) -> dict:
    """Model of all languages, trained on about ``sample_docs`` labelled documents
    outside the held-out fold (more if that is under ``LEAST_SAMPLES`` a language)."""
    small_batches(docs.sparkSession)
    usable = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    usable = usable.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("id").isNotNull() & ~held_out("id"))
    sizes = [(r["lang"], r["n"]) for r in usable.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(FOLDS * max_langs + 1).collect()]
    if not sizes:
        return train([])
    if len(sizes) > FOLDS * max_langs:
        raise ValueError(f"more than {FOLDS * max_langs} labels: not languages, or max_langs has to grow")
    each = max(sample_docs / len(sizes), LEAST_SAMPLES)
    # a language of at most ``each`` rows gives all, the others a share by the whole hash
    bounds = [(lang, min(int(each / n * 2**64) - 2**63, 2**63 - 1)) for lang, n in sizes]
    bounds = docs.sparkSession.createDataFrame(bounds, "lang string, bound long")
    picked = usable.join(F.broadcast(bounds), "lang").where(F.xxhash64("id") <= F.col("bound")).select("lang", "text").limit(int(2 * each * len(sizes))).collect()
    picked = [(r["lang"], r["text"]) for r in picked]
    for lang in sorted({lang for lang, _ in sizes} - {lang for lang, _ in picked}):     # few ids, all outside of the share
        rows = usable.where(F.col("lang") == lang).orderBy(F.xxhash64("id", "text")).limit(int(each)).collect()
        picked += [(lang, r["text"]) for r in rows]
    return train(picked, max_langs=max_langs)


def identify(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", penalty: float = 12.0) -> DataFrame:
    """``(id, lang_pred, score, spans)``, one row per document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)    # at most 3 x BUCKETS x max_langs floats
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(_identify(shared, penalty), "id long, lang_pred string, score double, spans string")


def _kept(shared, penalty: float, text_at: int, min_score: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets, _ = utf8(batch.column(text_at))
            for i, j in row_slices(offsets, _slice_bytes(shared.value)):
                part = batch.slice(i, j - i)
                lang, score, _ = classify([t or "" for t in part.column(text_at).to_pylist()], shared.value, penalty)
                yield part.filter(pa.array([x != UNKNOWN and s >= min_score for x, s in zip(lang, score)], pa.bool_()))
    return run


def language_filter(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    penalty: float = 12.0, min_score: float = 0.4, **fitting) -> DataFrame:
    """``docs`` (all columns) without the documents that have no language: ``und``,
    or fewer than ``min_score`` of the letters in the predicted one."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, id_col, text_col, lang_col, **fitting))
    return docs.mapInArrow(_kept(shared, penalty, docs.columns.index(text_col), min_score), docs.schema)
