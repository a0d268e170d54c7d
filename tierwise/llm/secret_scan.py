"""Secret scan: assignment-aware lexing of source and configuration text.

Three base patterns (named assignments, access keys, long hexadecimal runs) are
found first.  The lexer then reads every assignment of a text (``name = "literal"``,
``name: literal``, ``"name": "literal"``, ``name => literal``) into a name and a
literal, follows names that were bound to a literal before (``KEY = "..."; password
= KEY``, over any number of steps), and scores each literal by how sensitive the
names are that it reaches and by how random it looks.  Literals at or above the
threshold that no base span covers are added.

Defined cases: a null or empty text has no span; repeated rows have equal results;
positions are code points, the end exclusive; the whole text counts at any length;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from hashlib import sha256
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import small_batches, utf8

KINDS = ("assign", "access", "hex")
# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_LITERAL, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
# How much the parts of a target's name speak for a secret.
SENSITIVE = {
    "password": 3.0, "passwd": 3.0, "passphrase": 3.0, "pwd": 3.0, "pass": 2.0, "secret": 3.0, "token": 2.5, "apikey": 3.0,
    "credential": 2.5, "credentials": 2.5, "auth": 1.5, "authorization": 2.0, "private": 1.5, "access": 1.0, "key": 1.5,
    "signing": 1.0, "encryption": 1.0, "client": 0.5, "api": 1.0, "bearer": 2.0, "dsn": 1.0,
}
PLACEHOLDER = re.compile(r"(?i)(example|changeme|change_me|placeholder|dummy|sample|redacted|your[_-]|xxxx|\*\*\*|todo|none|null|true|false)")
OPERATOR = re.compile(r":=|=>|[:=]")
LITERAL = re.compile(r"""[ \t]*(?:"([^"\n]*)"|'([^'\n]*)'|`([^`\n]*)`|([A-Za-z0-9+/_.=$@!%^&*~-]+))""")
IDENTIFIER = re.compile(r"[A-Za-z_$][A-Za-z0-9_.-]*")
_NAME = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_-.$")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_HEX_BYTES = np.zeros(256, bool)
_HEX_BYTES[[*b"0123456789abcdef"]] = True


def base_spans(text: str, hexes: bool = True) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the base patterns; a match that fails is dropped
    without another try inside it."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_LITERAL]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    if hexes:
        out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


def name_score(name: str) -> float:
    """Weight of the sensitive parts of a target's name."""
    parts = [p.lower() for p in _PART.findall(name)]
    return sum(SENSITIVE.get(p, 0.0) for p in dict.fromkeys(parts)) + (1.0 if "api" in parts and "key" in parts else 0.0)


def literal_score(literal: str) -> float:
    """How much a literal looks like key material: its length and entropy."""
    n = len(literal)
    if n < 8 or " " in literal or PLACEHOLDER.search(literal):
        return -10.0
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(literal).values())
    digits = any(c.isdigit() for c in literal)
    return min(entropy - 2.0, 2.5) + (0.5 if digits else -0.5)


def assignments(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """``(name, start, end, quoted)`` of each assignment and its literal."""
    upto = 0
    for op in OPERATOR.finditer(text):
        p = op.start()
        if p < upto:
            continue
        e = p
        while e > 0 and text[e - 1] in " \t":
            e -= 1
        if e > 0 and text[e - 1] in "\"'`":
            e -= 1
        s = e
        while s > upto and text[s - 1] in _NAME:
            s -= 1
        found = LITERAL.match(text, op.end()) if s < e else None
        if found:
            k = found.lastindex
            yield text[s:e], found.start(k), found.end(k), k < 4
            upto = found.end(k)


def lexed_spans(text: str, threshold: float = 4.0) -> list[tuple[int, int]]:
    """Literals that an assignment, or a chain of them, gives a sensitive name."""
    bound: dict[str, tuple[int, int]] = {}
    score: dict[tuple[int, int], float] = {}
    for name, s, e, quoted in assignments(text):
        value = text[s:e]
        span = bound.get(value) if not quoted else None
        if span is None:
            if not quoted and IDENTIFIER.fullmatch(value) and not any(c.isdigit() for c in value):
                bound.pop(name, None)       # a plain word or an unknown name, no literal
                continue
            span = (s, e)
        bound[name] = span
        score[span] = max(score.get(span, 0.0), name_score(name))
    return [span for span, weight in score.items() if weight > 0 and weight + literal_score(text[span[0]:span[1]]) >= threshold]


def scan(text: str, hexes: bool = True, threshold: float = 4.0) -> tuple[list, list]:
    """``(base spans, all spans)`` in order, each ``(start, end, kind)``."""
    base = base_spans(text, hexes)
    added = []

    def order(x):
        return x[0], KINDS.index(x[2]), x[1]
    if "=" in text or ":" in text:
        base = sorted(base, key=order)
        starts, reach = [a for a, _, _ in base], list(accumulate((b for _, b, _ in base), max))
        # a base span holds (s, e) if one that starts by s reaches e
        for s, e in lexed_spans(text, threshold):
            i = bisect_right(starts, s)
            if not i or reach[i - 1] < e:
                added.append((s, e, "assign"))
    return sorted(base, key=order), sorted(base + added, key=order)


def _joined(spans: list) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def _has_hex(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows whose bytes hold a long enough run of hexadecimal digits."""
    rows = np.zeros(len(offsets) - 1, bool)
    for at in range(int(offsets[0]), int(offsets[-1]), 8 << 20):
        lo, hi = max(at - LEAST_HEX, int(offsets[0])), min(at + (8 << 20), int(offsets[-1]))
        edge = np.diff(_HEX_BYTES[data[lo:hi]].astype(np.int8), prepend=0, append=0)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long = end - start >= LEAST_HEX
        for s, e in zip(start[long] + lo, end[long] + lo):      # a run may pass the end of a row
            rows[np.searchsorted(offsets, s, side="right") - 1:np.searchsorted(offsets, e, side="left")] = True
    return rows


def _scan(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets, _ = utf8(batch.column(1))
            hexes = _has_hex(data, offsets) if len(batch) else []
            rows = []
            for text, has in zip(batch.column(1), hexes):
                base, every = scan(text.as_py() or "", bool(has), threshold)
                n = Counter(k for _, _, k in base)
                rows.append((n["assign"], n["access"], n["hex"], sha256(_joined(base).encode()).hexdigest(), _joined(every)))
            cols = list(zip(*rows)) or [[]] * 5
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(cols, types)]],
                                             ["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])
    return run


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 4.0) -> DataFrame:
    """``id, n_assign, n_access, n_hex, base_sha256, spans``, one row per document."""
    small_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(_scan(threshold), "id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
