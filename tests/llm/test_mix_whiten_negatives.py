"""Source mixing, whitening and hard negatives against plain versions, and their edge cases."""

import random
import re
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierwise.llm import hard_negatives, mixing, whitening
from tierwise.llm.queries import op11_source_mix, op12_embedding_whitening

EMB = "vec_id long, embedding array<double>, label int, id long, row long, x string, a int, window int"


def vectors(spark, rows):
    """Rows (vec_id, vector, label) beside columns named like those the operators use."""
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], g, 1, 2, "x", 3, 4) for i, v, g in rows], EMB).repartition(3)


# -- mixing -------------------------------------------------------------------

def levelled(sizes: dict, weights, most: int) -> dict:
    """Targets by resharing the excess until no source is above its cap."""
    w = {g: weights[i % len(weights)] for i, g in enumerate(sorted(sizes))}
    target, open_, rest = {}, set(sizes), Fraction(sum(sizes.values()))
    while open_:
        level = rest / sum(w[g] for g in open_)
        above = {g for g in open_ if level * w[g] >= most * sizes[g]}
        if not above:
            return {**target, **{g: level * w[g] for g in open_}}
        for g in above:
            target[g] = Fraction(most * sizes[g])
            rest -= target[g]
        open_ -= above
    return target


def plain_mix(docs, weights=(5, 2, 1), most=3):
    rows = [(i, ("b" if s is None else "a" + s), len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, s in docs]
    sizes = defaultdict(int)
    for _, g, n in rows:
        sizes[g] += n
    target = levelled(sizes, weights, most)
    return [(i, n, sizes[g], float(target[g]), target[g] / sizes[g] if sizes[g] else None) for i, g, n in rows], sizes, target


def corpus(seed, n=400):
    rnd = random.Random(seed)
    def text():
        k = rnd.choice([0, 1, 3, 10, 60])
        return "".join(rnd.choice(["a", "bé", "x-y", "中", " "]) + rnd.choice([" ", "  ", "\t", "\n", "\x0b\x0c\r"]) for _ in range(k))
    docs = [(i, text(), rnd.choice(["s1", "s1", "s1", "é", "zz", "Z", None])) for i in range(n)]
    docs += [(None, None, "s1"), (None, "", None), (7, "a b", "s1"), (7, "a b", "s1"), (n, " \n ", "only blanks"), (n + 1, "one", "tiny")]
    return docs


def frame(spark, docs):
    schema = "doc_id long, text string, source string, id long, grp string, size long, m long, part int, nth long, rank long, __row long, __copy long"
    return spark.createDataFrame([(*d, 9, "g", 9, 9, 9, 9, 9, 9, 9) for d in docs], schema).repartition(5)


def test_words():
    texts = ["", "a", " a  b\tc\n", "é 中 x", "x" * 50, "  ", "a b"]
    data = "".join(texts).encode()
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    for most in (1, 5, 1000):
        got = mixing.words_in(np.frombuffer(data, np.uint8), offsets, max_bytes=most).tolist()
        assert got == [len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in texts]


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_targets_and_copies(spark, seed):
    docs = corpus(seed)
    want, sizes, target = plain_mix(docs)
    got = [tuple(r) for r in mixing.mix_plan(frame(spark, docs)).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted([(g[0], g[1], g[2]) for g in got], key=key) == sorted([(w[0], w[1], w[2]) for w in want], key=key)
    by = {}
    for w in want:
        by[(w[0], w[1], w[2])] = w
    copies = defaultdict(list)
    for i, size, source_size, tgt, n, taken in got:
        w = by[(i, size, source_size)]
        assert abs(tgt - w[3]) <= 1e-9 * max(1, w[3]) and taken == n * size
        share = w[4] or 0
        assert int(share) <= n <= -int(-share // 1) and n <= 3
        copies[source_size].append((size, n))
    for g, total in sizes.items():
        if list(sizes.values()).count(total) == 1 and total:
            rows = copies[total]
            # the emitted number is the expected one but for rounding, the words but for one long document
            assert abs(sum(n for _, n in rows) - float(target[g] / total) * len(rows)) <= 1
            assert abs(sum(s * n for s, n in rows) - target[g]) <= 2 * max(s for s, _ in rows)


def test_mix_reruns_agree_on_any_partitioning(spark):
    docs = frame(spark, corpus(3))
    one = sorted(map(str, mixing.mix_plan(docs).collect()))
    assert sorted(map(str, mixing.mix_plan(docs.repartition(11)).collect())) == one
    assert sorted(map(str, mixing.mix_plan(docs.coalesce(1)).collect())) == one


def test_mix_emits_the_documents(spark):
    docs = frame(spark, corpus(4))
    plan = mixing.mix_plan(docs)
    mix = mixing.mix_documents(docs)
    assert mix.columns == docs.columns
    words = F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("([^\\x20\\x09-\\x0D]+)"), 1))
    got = {r[0]: r[1] for r in mix.groupBy("source").agg(F.sum(words)).collect()}
    size = {r["id"]: r["taken"] for r in plan.where("id is not null").groupBy("id").agg(F.sum("taken").alias("taken")).collect()}
    mixed = {r[0]: r[1] for r in mix.where("doc_id is not null").groupBy("doc_id").agg(F.sum(words)).collect()}
    assert {k: v for k, v in size.items() if v} == {k: v for k, v in mixed.items() if v}
    assert got["tiny"] == 3


def test_mix_copies_and_hot_groups(spark):
    same = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("two words").alias("text"), F.lit("hot").alias("source"))
    rest = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("x").alias("source"))
    got = {r["source_size"]: r for r in mixing.mix_plan(same.union(rest)).groupBy("source_size").agg(F.sum("taken").alias("t"), F.max("copies").alias("m"), F.count("*").alias("n"), F.first("target").alias("g")).collect()}
    # the hot source weighs 5, the other 2 but stops at three times its 300 words
    assert (got[300]["t"], got[300]["m"], got[300]["n"], got[300]["g"]) == (900, 3, 100, 900.0)
    assert got[40_000]["n"] == 20_000 and got[40_000]["g"] == 39_400 and abs(got[40_000]["t"] - 39_400) <= 2


def test_mix_empty(spark):
    none = frame(spark, corpus(5)).limit(0)
    assert mixing.mix_plan(none).collect() == [] and mixing.mix_documents(none).collect() == []
    blank = frame(spark, [(1, None, "a"), (2, "", None)])
    assert sorted(tuple(r) for r in mixing.mix_plan(blank).collect()) == [(1, 0, 0, 0.0, 0, 0), (2, 0, 0, 0.0, 0, 0)]


def test_mix_long_text(spark):
    docs = spark.createDataFrame([(1, "word " * 400_000, "a"), (2, "one", "a"), (3, None, "b")], "doc_id long, text string, source string")
    got = {r["doc_id"]: r["size"] for r in op11_frame(docs).collect()}
    assert got == {1: 400_000, 2: 1, 3: 0}


def op11_frame(docs):
    return mixing.mix_plan(docs).withColumnRenamed("id", "doc_id")


# -- whitening ----------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 64])
def test_components_of_matrices(n):
    rng = np.random.default_rng(n)
    for kind in range(4):
        q, _ = np.linalg.qr(rng.standard_normal((n, n)))
        e = {0: rng.random(n) * 10, 1: np.ones(n), 2: np.concatenate([[5, 5, 5], np.ones(n)])[:n], 3: np.concatenate([[3.0], np.zeros(n)])[:n]}[kind]
        v = (q * e) @ q.T
        v = (v + v.T) / 2
        values, comps = whitening.leading_components(v, 4)
        k = min(4, n)
        assert np.allclose(values, np.sort(np.linalg.eigvalsh(v))[::-1][:k], atol=1e-12 * max(1, e.max()))
        assert np.allclose(comps @ comps.T, np.eye(k), atol=1e-12)
        assert np.abs(v @ comps.T - comps.T * values).max() <= 2e-13 * n * max(1, e.max())


def test_components_of_a_diagonal_matrix():
    values, comps = whitening.leading_components(np.diag([1.0, 4.0, 4.0, 2.0]), 4)
    assert np.allclose(values, [4, 4, 2, 1]) and np.allclose(comps @ comps.T, np.eye(4), atol=1e-14)
    assert np.array_equal(whitening.leading_components(np.zeros((3, 3)), 2)[0], np.zeros(2))


def plain_whitening(rows, k=4, grid=256):
    """(ids, x of every row, fit list, mean, eigenvalues, components, covariance)."""
    ids = [i for i, _ in rows]
    x = np.floor(np.array([v for _, v in rows], float) * grid).astype(np.int64)
    fit = np.unique(x, axis=0)
    c = fit - fit.mean(axis=0)
    v = c.T @ c / len(fit)
    e, q = np.linalg.eigh(v)
    return ids, x, fit, fit.mean(axis=0), e[::-1][:k], q[:, ::-1][:, :k], v


def test_whitening(spark):
    rng = np.random.default_rng(5)
    data = rng.standard_normal((300, 6)) @ rng.standard_normal((6, 6)) * 0.1
    rows = [(i, v.tolist()) for i, v in enumerate(data)] + [(1000 + i, data[0].tolist()) for i in range(50)] + [(3, data[3].tolist())]
    bad = [(9001, None, 0), (9002, [1.0, None, 0, 0, 0, 0], 0), (9003, [float("inf")] * 6, 0), (9004, [float("nan")] + [0] * 5, 0), (9005, [], 0), (9006, [1.0], 0), (9007, [1e300] + [0] * 5, 0)]
    got = whitening.embedding_whitening(vectors(spark, [(i, v, 0) for i, v in rows] + bad)).collect()
    ids, x, fit, mean, e, q, v = plain_whitening(rows)
    assert sorted((r["id"], r["component"]) for r in got) == sorted((i, c) for i in ids for c in range(1, 5))
    assert {r["n"] for r in got} == {300} and len({r["identity_error"] for r in got}) == 1
    assert got[0]["identity_error"] < 1e-10
    at = {i: k for k, i in enumerate(ids)}
    s = fit.sum(axis=0)
    sign = {}
    for r in got:
        k, c = at[r["id"]], r["component"] - 1
        assert int(r["deviation"]) == sum((300 * int(a) - int(b)) ** 2 for a, b in zip(x[k], s))
        assert abs(r["explained"] - e[c] / np.trace(v)) < 1e-12
        want = (x[k] - mean) @ q[:, c] / np.sqrt(e[c])
        sign.setdefault(c, np.sign(want * r["whitened"]))
        assert abs(r["whitened"] - sign[c] * want) < 1e-9


def test_whitening_degenerate(spark):
    assert whitening.embedding_whitening(vectors(spark, [(1, None, 0)]).limit(0)).collect() == []
    assert whitening.embedding_whitening(vectors(spark, [(1, None, 0)])).collect() == []
    got = whitening.embedding_whitening(vectors(spark, [(1, [0.5, 0.5], 0), (2, [0.5, 0.5], 1), (None, [0.5, 0.5], 1)])).collect()
    assert len(got) == 6 and {(r["n"], r["whitened"], r["explained"], r["identity_error"], int(r["deviation"])) for r in got} == {(1, None, 0.0, None, 0)}
    # one direction only: the second component has no variance
    got = whitening.embedding_whitening(vectors(spark, [(i, [i / 256, 2 * i / 256], 0) for i in range(5)])).collect()
    one, two = ([r for r in got if r["component"] == c] for c in (1, 2))
    assert {r["whitened"] for r in two} == {None} and all(abs(r["explained"] - 1) < 1e-12 for r in one)
    assert np.allclose(sorted(abs(r["whitened"]) for r in one), [0, 0.5 ** 0.5, 0.5 ** 0.5, 2 ** 0.5, 2 ** 0.5])


def test_whitening_large_entries(spark):
    """Deviations beyond 64 bits stay exact."""
    data = [(i, [i * 2.0 ** 30, -i * 2.0 ** 33], 0) for i in range(1, 9)]
    got = whitening.embedding_whitening(vectors(spark, data), components=1).collect()
    x = {i: [int(c * 256) for c in v] for i, v, _ in data}
    s = [sum(c) for c in zip(*x.values())]
    assert {r["id"]: int(r["deviation"]) for r in got} == {i: sum((8 * a - b) ** 2 for a, b in zip(v, s)) for i, v in x.items()}
    assert max(int(r["deviation"]) for r in got) > 2**63


def test_whitening_query_on_the_table(spark, sf_small):
    got = op12_embedding_whitening(spark, sf_small).collect()
    assert got and all(r["identity_error"] <= 1e-8 for r in got)


# -- hard negatives -----------------------------------------------------------

def plain_negatives(rows, is_anchor, k=5, m=3, low=50, high=95):
    keep = [(i, np.floor(np.array(v, float) * 256).astype(np.int64), g) for i, v, g in rows
            if g is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    order = lambda r: (-r[1], r[0] is None, r[0] or 0)
    for p, (a, x, g) in enumerate(keep):
        if a is None or not is_anchor(a):
            continue
        score = [(i, int(x @ y), h) for q, (i, y, h) in enumerate(keep) if q != p and len(y) == len(x)]
        score = [(i, s, h) for i, s, h in score]
        for pi, ps, _ in sorted((r for r in score if r[2] == g), key=order)[:k]:
            bad = sorted((r for r in score if r[2] != g and low * ps <= 100 * r[1] <= high * ps), key=order)[:m]
            out += [(a, pi, n + 1, i, ps, s) for n, (i, s, _) in enumerate(bad)]
    return sorted(map(str, out))


def clusters(seed, n=400, dims=6, tight=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((8, dims))
    return [(i, (centres[(k := int(rng.integers(8)))] + tight * rng.standard_normal(dims)).tolist(), int((k + rng.integers(2)) % 4)) for i in range(n)]


@pytest.mark.parametrize("seed,block_rows", [(1, 8), (2, 64), (3, 1024)])
def test_negatives(spark, seed, block_rows):
    rows = clusters(seed)
    rows += [(500 + i, rows[0][1], i % 3) for i in range(40)]                       # copies tie
    rows += [(600, None, 1), (601, [1.0, None, 0, 0, 0, 0], 1), (602, rows[1][1], None), (603, [float("inf")] * 6, 1), (700, [0.0] * 6, 1), (701, [0.0] * 6, 2),
             (710, [1.0, 2.0], 1), (711, [1.0, 2.0], 1), (712, [0.9, 1.8], 2), (None, rows[2][1], 1), (720, [1.0], 3)]
    got = hard_negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") % 10 == 0, F.col("label"), block_rows=block_rows)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(str(tuple(r)) for r in got.collect()) == plain_negatives(rows, lambda i: i % 10 == 0)


def test_negatives_read_few_blocks(spark):
    """On clustered data most blocks are left unread, and every needed one is read."""
    rows = clusters(7, n=1500, dims=4, tight=0.02)
    df = vectors(spark, rows)
    blocks = hard_negatives.candidate_blocks(df, "vec_id", "embedding", F.col("label"), F.col("vec_id") % 50 == 0, 256, 16, 4)
    anchors = blocks.select("label", "width", "ids", "rows", "anchors", "q").mapInArrow(hard_negatives._anchors, "a long, anchor_id long, label string, width int, vec binary")
    whole = anchors.withColumns({"floor": F.array(F.lit(-hard_negatives.OPEN)), "top": F.array(F.lit(hard_negatives.OPEN))})
    best, read = hard_negatives.search(blocks, whole, same_label=True, k=5)
    labels = {r["block"]: r["label"] for r in blocks.select("block", "label").collect()}
    of = {r["a"]: r["label"] for r in anchors.collect()}
    there = sum(1 for a in of for b in labels if labels[b] == of[a])
    assert best.count() == 5 * len(of) and read.count() < there / 2


def test_bounds_hold():
    rng = np.random.default_rng(1)
    a, x = rng.integers(-300, 300, (20, 7)), rng.integers(-300, 300, (50, 7))
    least, most = hard_negatives.bounds(a, x.min(axis=0)[None], x.max(axis=0)[None])
    s = a @ x.T
    assert (least[:, 0] <= s.min(axis=1)).all() and (most[:, 0] >= s.max(axis=1)).all()
    big = np.array([[2**29, -2**29]])
    assert hard_negatives.dot(big, big)[0, 0] == 2**59


def test_hilbert_curve():
    """Each point once, neighbours on the curve are neighbours in space."""
    for d, bits in ((2, 3), (3, 2), (4, 2)):
        side = 1 << bits
        x = np.array(np.meshgrid(*[range(side)] * d)).reshape(d, -1).T
        keys = hard_negatives.hilbert_keys(x, bits)
        assert len(set(keys)) == len(x)
        walk = x[sorted(range(len(x)), key=lambda i: keys[i])]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_negatives_empty(spark):
    none = vectors(spark, clusters(1, n=3)).limit(0)
    assert hard_negatives.hard_negatives(none, F.col("vec_id") % 10 == 0, F.col("label")).collect() == []
    one = vectors(spark, [(0, [1.0, 2.0], 1)])
    assert hard_negatives.hard_negatives(one, F.col("vec_id") % 10 == 0, F.col("label")).collect() == []
    assert hard_negatives.hard_negatives(vectors(spark, clusters(1, n=30)), F.lit(None).cast("boolean"), F.col("label")).collect() == []


# -- secrets ------------------------------------------------------------------

def test_spans_of_a_text_with_many_assignments():
    """Spans inside a base span are left out, and 30,000 of them take seconds."""
    import time

    from tierwise.llm import secret_scan
    lines = [f'password = "abcdefghij{i:06d}"\napi_secret_{i} := "zyxwvutsrq{i:06d}"' for i in range(15_000)]
    t0 = time.time()
    base, every = secret_scan.scan("\n".join(lines))
    assert time.time() - t0 < 30
    small_base, small = secret_scan.scan("\n".join(lines[:200]))
    naive = [(s, e) for s, e in secret_scan.lexed_spans("\n".join(lines[:200])) if not any(a <= s and e <= b for a, b, _ in small_base)]
    assert [x for x in small if x not in small_base] == [(s, e, "assign") for s, e in sorted(naive)]
    assert len(base) >= 15_000 and len(every) >= len(base)
