"""Best-fit-decreasing packing of documents into sequences of bounded length.

Lengths lie between 1 and the capacity, so documents of one length are
interchangeable and the exact best-fit-decreasing packing of the whole corpus
follows from the count of each length.  That histogram has at most ``capacity``
rows at any input size.  A segment tree over the remaining capacities finds the
tightest open bin in logarithmic time; equal bins are kept as runs, so a run of
documents of one length is placed in one step.  The plan (runs of ranks to runs
of bins) is bounded by the capacity as well, and every document looks up its
place by its rank among the documents of its length.

Defined cases: a null or empty text is the end id alone; repeated rows are
packed one by one; an empty table gives an empty result; other columns of the
input are not read; pieces of a document too long for one sequence are full but
for the last.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierwise.llm.common import utf8, written

END = b"\0\0\0\0"
#: Words that normalization leaves alone but for case, then punctuation that makes one token group.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
MARKS = bytes(c for c in range(0x21, 0x7F) if c != 0x27 and not chr(c).isalnum())
_ENCODERS: dict[str, WordEncoder] = {}


class Recent(dict):
    """Values made on demand; of at most two generations of ``keep`` entries the older
    one goes as a whole, and what was used again since has moved on."""

    def __init__(self, make, keep: int):
        super().__init__()
        self.make, self.keep, self.old = make, keep, {}

    def __missing__(self, key):
        if len(self) >= self.keep:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


class WordEncoder:
    """Token ids of whole texts, with each recent distinct word tokenized once.

    The vocabulary's rules never join across ASCII white space, so a text's ids
    are those of its words.  A word of plain Latin letters goes straight to the
    vocabulary's merges, whatever its case and the punctuation after it; any other
    word goes through all of the tokenizer's steps.  Each table holds at most
    ``2 * keep`` entries.
    """

    def __init__(self, path: str, keep: int = 250_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # the byte-level form of each Latin-1 character, as the tokenizers' own step writes it
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.level = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}
        self.bytes_of = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.letters = Recent(self.merged, keep)
        self.marks = Recent(self.whole, keep)
        self.known = Recent(self.word, keep)

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        if path not in _ENCODERS:
            _ENCODERS[path] = cls(path)
        return _ENCODERS[path]

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def merged(self, letters: str) -> bytes:
        return b"".join([self.bytes_of[t.id] for t in self.model.tokenize(letters)])

    def word(self, word: bytes) -> bytes:
        core = word.rstrip(MARKS)
        if core.isalpha():                          # ASCII letters only
            ids = self.letters[core.lower().decode()]
            return ids if len(core) == len(word) else ids + self.marks[word[len(core):].decode()]
        text = word.decode("utf-8", "replace")
        plain = PLAIN.fullmatch(text)
        if plain is None or "<|" in text:
            return self.whole(text)
        letters, marks = plain.groups()
        return self.letters[letters.lower().translate(self.level)] + (self.marks[marks] if marks else b"")

    def ids(self, text: bytes) -> bytes:
        """Little-endian unsigned 32-bit ids of a UTF-8 text."""
        return b"".join(map(self.known.__getitem__, text.split()))


def _pieces(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = WordEncoder.of(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)     # of each length, in this task
        for batch in batches:
            ids = batch.column(0).to_pylist()
            data, offsets, _ = utf8(batch.column(1))
            raw = memoryview(data)
            rows = []
            for doc, s, e in zip(ids, offsets[:-1].tolist(), offsets[1:].tolist()):
                tokens = encoder.ids(bytes(raw[s:e])) + END
                for k, at in enumerate(range(0, len(tokens), 4 * capacity)):
                    cut = tokens[at:at + 4 * capacity]
                    n = len(cut) // 4
                    rows.append((doc, k, at // 4, n, zlib.crc32(cut), int(seen[n])))
                    seen[n] += 1
            cols = list(zip(*rows)) or [[]] * 6
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            out = [pa.array(c, t) for c, t in zip(cols, types)] + [pa.array(np.full(len(rows), part, np.int32))]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "piece", "start", "length", "ids_crc32", "nth", "part"])
    return run


class CapacityTree:
    """Segment tree over the remaining capacities that open bins have."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.size)

    def put(self, r: int, there: bool) -> None:
        i = r + self.size
        self.any[i] = there
        while i > 1:
            i //= 2
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]

    def tightest(self, need: int) -> int | None:
        """Smallest remaining capacity of at least ``need`` that an open bin has."""
        i = need + self.size
        if self.any[i]:
            return need
        while i > 1:
            if i % 2 == 0 and self.any[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return None


def best_fit_plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rows ``(length, first rank, documents a bin, first bin, offset)``: documents
    of a length, from that rank on, fill successive bins from that offset on."""
    tree, open_bins, plan, bins = CapacityTree(capacity), {}, [], 0

    def add(r: int, first: int, n: int) -> None:
        if r and n:
            open_bins.setdefault(r, []).append((first, n))
            tree.put(r, True)

    for s in sorted(counts, reverse=True):
        left, rank = counts[s], 0
        while left:
            r = tree.tightest(s)
            if r is None:
                r, first, n = capacity, bins, -(-left // (capacity // s))
                bins += n
            else:
                first, n = open_bins[r].pop()
                if not open_bins[r]:
                    tree.put(r, False)
            each = min(r // s, left)
            used = min(n, left // each)
            plan.append((s, rank, each, first, capacity - r))
            rank, left = rank + used * each, left - used * each
            add(r - each * s, first, used)
            if r < capacity:
                add(r, first + used, n - used)
            else:
                bins -= n - used
    return np.array(plan, np.int64).reshape(-1, 5)


def _place(plan: np.ndarray):
    lengths = plan[:, 0]
    order = np.lexsort((plan[:, 1], lengths))
    plan = plan[order]
    # one sorted key for (length, rank): ranks stay below 2**50
    keys = (plan[:, 0] << 50) + plan[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            row = plan[np.searchsorted(keys, (length << 50) + rank, side="right") - 1] if len(length) else plan[:0]
            nth = rank - row[:, 1]
            each = np.maximum(row[:, 2], 1)
            out = batch.columns[:5] + [pa.array(row[:, 3] + nth // each), pa.array(row[:, 4] + nth % each * length)]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return run


def best_fit_packing(docs: DataFrame, tokenizer_path: str, capacity: int = 2048,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id,
    offset``.  Each text is tokenized once."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = written(src.mapInArrow(_pieces(tokenizer_path, capacity), "doc_id long, piece int, start long, length long, ids_crc32 long, nth long, part int"), "packing-pieces")
    each = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = each.select("length", "part", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    counts = {r["length"]: r["n"] for r in each.groupBy("length").agg(F.sum("n").alias("n")).collect()}    # at most `capacity` rows
    ranked = (pieces.join(before, ["length", "part"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("before")).alias("rank")))
    return ranked.mapInArrow(_place(best_fit_plan(counts, capacity)), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
