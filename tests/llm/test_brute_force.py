"""Every operator against a plain version of its contract."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tierwise.llm import decontamination, embedding, language, line_dedup, packing, pii, secret_scan, simhash, substring_dedup, toxicity
from tierwise.llm.common import connected_components, sampled
from tierwise.llm.queries import word_tokenizer
from tierwise.session import shared_dir


class Groups:
    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def edited(rnd, text, n, alphabet="abcdefgh é"):
    out = list(text)
    for _ in range(n):
        k = rnd.random()
        if k < 0.33 and out:
            out[rnd.randrange(len(out))] = rnd.choice(alphabet)
        elif k < 0.66 and out:
            del out[rnd.randrange(len(out))]
        else:
            out.insert(rnd.randint(0, len(out)), rnd.choice(alphabet))
    return "".join(out)


def texts_of(spark, sf_small):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}


def frame(spark, docs):
    return spark.createDataFrame(sorted(docs.items()), "doc_id long, text string").repartition(4)


# -- components ---------------------------------------------------------------

def test_components(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, i) for i in range(6000, 6100)]
    want = Groups()
    for a, b in edges:
        want.join(a, b)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: want.find(x) for e in edges for x in e if want.find(x) != x}


# -- SimHash --------------------------------------------------------------------

def plain_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def test_fingerprints():
    for text in ["", " \t\n", "One", "a B c", "É a  b\x0bC d", "x y z w", "a b c d " * 30]:
        assert simhash.fingerprint_bytes(text.encode()) == plain_fingerprint(text)


@pytest.mark.parametrize("bucket_rows", [8192, 6])
def test_simhash_components(spark, bucket_rows):
    rnd = random.Random(4)
    fps = {rnd.getrandbits(64) for _ in range(100)}
    for _ in range(6):      # dense groups, so small buckets are dealt anew twice
        centre = rnd.getrandbits(64)
        fps |= {centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 3))) for _ in range(40)}
    fps = sorted(fps)
    want = Groups()
    for a, b in itertools.combinations(fps, 2):
        if (a ^ b).bit_count() <= 3:
            want.join(a, b)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    got = Groups()
    for r in simhash.links(spark.createDataFrame(signed, "fp long"), 3, bucket_rows).collect():
        a, b = r["a"] % (1 << 64), r["b"] % (1 << 64)
        assert (a ^ b).bit_count() <= 3
        got.join(a, b)
    assert [got.find(f) for f in fps] == [want.find(f) for f in fps]


# -- substrings -------------------------------------------------------------------

def plain_substrings(docs, length=100):
    seen, out = set(), {}
    for d in sorted(docs):
        b = (docs[d] or "").encode()
        gone = np.zeros(len(b) + 1, int)
        for p in range(len(b) - length + 1):
            if b[p:p + length] in seen:
                gone[p:p + length] = 1
            seen.add(b[p:p + length])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[d] = (len(b), int(gone.sum()), int((np.diff(gone, prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("options", [{}, {"bucket_bytes": 3000, "block_bytes": 20_000}])
def test_substrings(spark, sf_small, options):
    rnd = random.Random(5)
    docs = dict(itertools.islice(texts_of(spark, sf_small).items(), 120))
    passage = next(t for t in docs.values() if len(t) > 700)[:700]
    docs |= {90001: None, 90002: "", 90003: "ab" * 400, 90004: "x" * 99, 90005: "x" * 100, 90006: "x" * 250, 90007: "é" * 200 + passage[:300]}
    docs |= {91000 + i: edited(rnd, "", 150) + passage + edited(rnd, "", 150) for i in range(40)}
    got = {r["id"]: tuple(r)[1:5] for r in substring_dedup.substring_dedup(frame(spark, docs), **options).collect()}
    assert got == plain_substrings(docs)


@pytest.mark.parametrize("length", [100, 48, 51])
def test_difference_cover(length):
    rnd = random.Random(length)
    for _ in range(20):
        pool = np.frombuffer(("".join(rnd.choice("ab") for _ in range(20)) * 60).encode(), np.uint8).copy()
        for _ in range(rnd.randint(0, 8)):
            pool[rnd.randrange(len(pool))] = ord("c")
        at = np.array(sorted(rnd.sample(range(len(pool) - length), 300)))
        order = np.array(rnd.sample(range(300), 300))
        first = {}
        for i, o in zip(at, order):
            key = pool[i:i + length].tobytes()
            first[key] = min(first.get(key, 999), o)
        want = [first[pool[i:i + length].tobytes()] < o for i, o in zip(at, order)]
        assert substring_dedup.cover_repeats(pool, at, order, length).tolist() == want


# -- packing ------------------------------------------------------------------------

def test_best_fit_plan():
    rnd = random.Random(6)
    for _ in range(150):
        capacity = rnd.choice([10, 17, 64])
        sizes = [rnd.randint(1, capacity) for _ in range(rnd.randint(0, 150))]
        bins = []
        for s in sorted(sizes, reverse=True):
            fit = [(r, i) for i, r in enumerate(bins) if r >= s]
            if fit:
                bins[min(fit)[1]] -= s
            else:
                bins.append(capacity - s)
        counts = Counter(sizes)
        plan = packing.best_fit_plan(counts, capacity)
        spans = {}
        for s, n in counts.items():
            rows = plan[plan[:, 0] == s]
            for k in range(n):
                r = rows[np.searchsorted(rows[:, 1], k, side="right") - 1]
                spans.setdefault(r[3] + (k - r[1]) // r[2], []).append((r[4] + (k - r[1]) % r[2] * s, s))
        left = []
        for places in spans.values():
            at = 0
            for offset, s in sorted(places):
                assert offset == at
                at += s
            left.append(capacity - at)
        assert sorted(left) == sorted(bins)


def test_packing_round_trip(spark, sf_small):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(word_tokenizer())
    docs = texts_of(spark, sf_small) | {90001: None, 90002: "<|endoftext|> it's 12 ΣΑΣ. é 日本\x1cx y", 90003: "token " * 5000}
    ids = {d: whole.encode(t or "", add_special_tokens=False).ids + [0] for d, t in docs.items()}
    rows = packing.best_fit_packing(frame(spark, docs), word_tokenizer()).collect()
    assert Counter(r["doc_id"] for r in rows) == {d: -(-len(x) // 2048) for d, x in ids.items()}
    at = Counter()
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at[r["sequence_id"]] and r["start"] == 2048 * r["piece"]
        at[r["sequence_id"]] += r["length"]
        cut = np.array(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]], "<u4").tobytes()
        assert len(cut) == 4 * r["length"] and zlib.crc32(cut) == r["ids_crc32"]
    total = sum(map(len, ids.values()))
    assert sum(at.values()) == total and max(at.values()) <= 2048
    assert len(at) <= -(-total // 2048) * 11 // 9 + 1


# -- decontamination --------------------------------------------------------------------

def test_leaks(spark, sf_small):
    rnd = random.Random(7)
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()}
    clean = {d: t for d, t in texts_of(spark, sf_small).items() if not any(x in t for x in items.values())}
    planted = {}
    for i in range(80):
        item = rnd.choice(list(items))
        host = rnd.choice(list(clean.values()))
        cut = rnd.randrange(len(host) + 1)
        body = items[item].upper() if i % 4 == 0 else edited(rnd, items[item], int(0.07 * len(items[item])), "abcdefgh")
        planted[10_000 + i] = (item, host[:cut] + " " + body + " " + host[cut:], cut + 1, cut + 1 + len(body))
    docs = clean | {d: t for d, (_, t, _, _) in planted.items()}
    bench = spark.createDataFrame(sorted(items.items()), "item_id long, text string")
    for options in ({}, {"index_bytes": 3000}):
        found = decontamination.find_leaks(frame(spark, docs), bench, **options).collect()
        assert {(r["id"], r["item_id"]) for r in found} >= {(d, p[0]) for d, p in planted.items()}
        assert not {r["id"] for r in found} & set(clean)
        for r in found:
            item, _, s, e = planted[r["id"]]
            assert item != r["item_id"] or s - 12 <= r["start"] < r["end"] <= e + 12
    kept = {r["doc_id"] for r in decontamination.decontaminate(frame(spark, docs), bench).collect()}
    assert kept == set(clean)


def test_leaks_in_many_blocks(spark):
    """Blocks of items, and one text that a thousand items share, change no result; the
    plan of the result scans no document in Python."""
    rnd = random.Random(11)
    words = ["".join(rnd.choices("abcdefghij", k=rnd.randrange(3, 9))) for _ in range(400)]
    texts = [" ".join(rnd.choices(words, k=40)) for _ in range(30)]
    items = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, texts[3]) for i in range(1000)] + [(5000, None), (None, texts[5]), (6000, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = {i: " ".join(rnd.choices(words, k=60)) for i in range(40)}
    docs |= {100 + i: docs[i] + " " + texts[i] + " " + docs[i + 1] for i in range(8)} | {200: None, 201: ""}
    one = decontamination.find_leaks(frame(spark, docs), bench)
    found = decontamination.find_leaks(frame(spark, docs), bench, index_bytes=900)
    assert decontamination.Items(bench, index_bytes=900).blocks >= 8
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, found.collect()))
    assert {r["id"] for r in one.collect()} == set(range(100, 108)) and one.where("id = 103").count() == 1001
    for options in ({}, {"index_bytes": 900}):
        kept = decontamination.decontaminate(frame(spark, docs).withColumn("digest", F.lit("x")), bench, **options)
        assert {r["doc_id"] for r in kept.collect()} == set(docs) - set(range(100, 108)) and kept.columns[-1] == "digest"
    assert "MapInArrow" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in kept._jdf.queryExecution().optimizedPlan().toString()


def leaks_of(items, texts):
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
    found = decontamination.matches(decontamination.Index(items), data, np.concatenate(([0], np.cumsum([len(x) + 1 for x in raw]))))
    return [(r, item, raw[r][s:e].decode()) for r, item, s, e, _ in found]


@pytest.mark.parametrize("size,quote", [(394, 200), (394, 120), (180, 120)])
def test_partial_quotes(size, quote):
    rnd = random.Random(size + quote)

    def words(n):
        return " ".join("".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 9))) for _ in range(n))[:n]
    item = words(size)
    quotes = [item[s:s + quote] for s in range(size - quote + 1)]
    texts = [words(rnd.randint(1, 400)) + "; " + q + ", " + words(rnd.randint(1, 400)) for q in quotes] + [words(900) for _ in range(20)]
    found = leaks_of([(7, item), (8, words(300))], texts)
    assert {(r, i) for r, i, _ in found} == {(r, 7) for r in range(len(quotes))}
    assert all(len(text) >= 90 and text[25:-25] in quotes[r] for r, _, text in found)     # the edits may lie at the ends


def test_short_items():
    items = [(1, "Who wrote Faust?"), (2, "a b"), (3, "42 is it"), (4, "Who wrote Faust"), (5, "")]
    texts = ["who  WROTE faust", "I ask: who wrote Faust, then?", "who wrote fausts", "a bc a-B", "ab a", "42 is it 42 is it", "twho wrote faust", "a", "b 42 is", ""]
    assert leaks_of(items, texts) == [(0, 1, "who  WROTE faust"), (0, 4, "who  WROTE faust"), (1, 1, "who wrote Faust"), (1, 4, "who wrote Faust"), (3, 2, "a-B"),
                                      (5, 3, "42 is it"), (5, 3, "42 is it")]


# -- language -----------------------------------------------------------------------------

def test_viterbi():
    rng = np.random.default_rng(8)
    for _ in range(60):
        offsets = np.concatenate(([0], np.cumsum(rng.integers(0, 5, 4))))
        scores = rng.normal(size=(offsets[-1], 3)) * 2
        label = language.viterbi(scores, offsets, 1.3)
        for a, b in itertools.pairwise(offsets):
            def value(p, a=a):
                return sum(scores[a + i, x] for i, x in enumerate(p)) - 1.3 * sum(x != y for x, y in itertools.pairwise(p))
            if a < b:
                assert value(label[a:b]) == pytest.approx(max(map(value, itertools.product(range(3), repeat=b - a))))


def test_language_accuracy(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small.replace('0.001', '0.01')}/documents.parquet")
    model = language.fit(docs)
    want = {r["doc_id"]: r["lang"] for r in docs.collect()}
    got = {r["id"]: r for r in language.identify(docs, model).collect()}
    held = [d for d in want if zlib.crc32(str(d).encode()) % 4 == 2]
    assert np.mean([got[d]["lang_pred"] == want[d] for d in held]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())
    text = {lang: next(r["text"] for r in docs.collect() if r["lang"] == lang and 300 < r["n_chars"] < 900) for lang in ("en", "de")}
    (_, _, spans), = zip(*language.classify([text["en"] + "\n" + text["de"]], model, 12.0))
    assert spans.startswith("en:0:") and ",de:" in spans


def test_every_language_is_learned(spark):
    words = {"en": "this is english text", "de": "dies ist deutscher text", "fr": "ceci est un texte", "es": "este es un texto corto", "el": "αυτό είναι ελληνικά"}
    rows = [(i, x, text) for k, (x, text) in enumerate(words.items()) for i in range(1000 * k, 1000 * k + (400 if x == "en" else 8))]
    docs = spark.createDataFrame(rows + [(3, "xx", "wholly other vocabulary")] * 500, "doc_id long, lang string, text string")
    for options in ({}, {"sample_docs": 0.001}, {"max_langs": 2}):      # a share below a millionth; more languages than max_langs
        model = language.fit(docs, **options)
        assert model["langs"] == sorted([*words, "xx"])
        assert model["tables"].size <= 3 * language.BUCKETS * options.get("max_langs", 200)
        assert language.classify(list(words.values()), model, 4.0)[0] == list(words)
    with pytest.raises(ValueError, match="labels"):
        language.fit(spark.range(200).selectExpr("id AS doc_id", "cast(id AS string) AS lang", "'a' AS text"), max_langs=2)


def test_sampled_shares(spark):
    ids = spark.range(1_000_000)
    assert ids.where(sampled(1.0, "id")).count() == 1_000_000 and ids.where(sampled(0.0, "id")).count() == 0
    assert 60 <= ids.where(sampled(1e-4, "id")).count() <= 140
    assert spark.range(20_000_000).where(sampled(4e-7, "id")).count() > 0


def test_scripts():
    model = language.train([("ru", "привет мир это русский текст"), ("el", "αυτό είναι ελληνικά"), ("en", "this is english text")])
    assert language.classify(["ελληνικά", "текст", "english", "𝒳𝒴 12", "١٢ ..."], model, 4.0)[0][:3] == ["el", "ru", "en"]
    assert language.classify(["12 ...", ""], model, 4.0)[0] == ["und", "und"]


# -- embeddings ------------------------------------------------------------------------------

@pytest.mark.parametrize("options", [{}, {"cell_rows": 60, "block_rows": 25, "margin": 0.2}, {"cell_rows": 60}])
def test_embeddings(spark, options):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(400, 16))
    x = np.concatenate([x, x[:100] + rng.normal(size=(100, 16)) * 0.12, x[:60] * 3, np.repeat(x[:1], 40, axis=0) + rng.normal(size=(40, 16)) * 0.05])
    label = rng.integers(0, 3, len(x))
    label[400:500] = label[:100]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.98) & (label[:, None] == label[None, :])
    want = Groups()
    for i, j in zip(*np.nonzero(near)):
        want.join(int(i), int(j))
    df = spark.createDataFrame([(i, x[i].tolist(), int(label[i])) for i in range(len(x))], "vec_id long, embedding array<double>, label int").repartition(4)
    got = {r["id"]: r for r in embedding.embedding_near_dedup(df, **options).collect()}
    links = near.sum(axis=1) - 1
    found = sum(got[i]["n_links"] for i in range(len(x)))
    assert all(got[i]["n_links"] <= links[i] for i in range(len(x)))
    assert found == links.sum() and [got[i]["component_id"] for i in range(len(x))] == [want.find(i) for i in range(len(x))]
    assert all(r["kept"] == (r["id"] == r["component_id"]) for r in got.values())


@pytest.mark.parametrize("kind", ["float", "double"])
def test_embeddings_of_many_blocks(spark, kind):
    """Blocks of one label, in both directions: chains through cells, a group of near copies,
    copies, rows without id, repeated ids."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(900, 6))
    x[500:700] = x[0] + rng.normal(size=(200, 6)) * 0.02
    x[700:800] = x[100:200] * 2
    x = x.astype(np.float32) if kind == "float" else x
    ids = [None if i in (5, 296, 587, 684, 878) else 3 if i == 850 else i for i in range(len(x))]
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.98
    want = Groups()
    for i, j in zip(*np.nonzero(near)):
        if ids[i] is not None and ids[j] is not None:
            want.join(ids[int(i)], ids[int(j)])
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in zip(ids, x)], f"vec_id long, embedding array<{kind}>, label int").repartition(4)
    for options in ({"cell_rows": 60, "block_rows": 10}, {"cell_rows": 30, "block_bytes": 24 * 40}, {"cell_rows": 5000, "block_rows": 10}):
        got = embedding.embedding_near_dedup(df, **options).collect()
        key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)
        assert sorted(((r["id"], r["n_links"], r["component_id"]) for r in got), key=key) == sorted(
            ((i, int(n) - 1, None if i is None else want.find(i)) for i, n in zip(ids, near.sum(axis=1))), key=key)


def test_embeddings_are_not_copied_to_each_cell(spark):
    """What a run writes follows the vectors, not their cells: unrelated vectors lie near the
    borders of most cells."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(3000, 64)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int").repartition(4)
    root = Path(shared_dir(spark)) / "tierwise"
    before = set(root.glob("embedding-*"))
    assert embedding.embedding_near_dedup(df, cell_rows=60, block_rows=500).where("n_links > 0").count() == 0
    new = set(root.glob("embedding-*")) - before
    assert new and sum(f.stat().st_size for d in new for f in d.glob("*.parquet")) < 2 * x.nbytes
    digests = [hashlib.md5(v.tobytes()).digest() for v in x]
    models = {("0", 64): embedding.spherical_kmeans(embedding._unit(x), 50)}
    home = np.argmax(embedding._unit(x) @ models["0", 64].T, axis=1)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["0"] * 3000), pa.array([64] * 3000, pa.int32()), pa.array(digests), pa.array(home.astype(np.int32)), pa.array(range(3000)), pa.array([1] * 3000), pa.array([v.tobytes() for v in x])],
        ["label", "width", "digest", "cell", "id", "copies", "vec"])
    dealt = embedding._dealt("<f4", models, {("0", 64): np.bincount(home, minlength=50)}, lambda width: 500, 0.2)(iter([batch]))
    keys = Counter((r["digest"], r["key"]) for out in dealt for r in out.select(["digest", "key"]).to_pylist())
    assert max(keys.values()) == 1 and len({d for d, _ in keys}) == 3000 and len(keys) <= 3.5 * 3000


# -- secrets ------------------------------------------------------------------------------------

def test_secret_base():
    rnd = random.Random(10)
    plain = {"assign": r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
             "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+"}
    parts = ["token", "=", ":", " ", "'", '"', "AKIA", "ABCD", "0123456789", "abcdef", "PassWord", "api_key", "ſecret", "é", "\n", "/"]
    for _ in range(3000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14)))
        want = [(m.start(), m.end(), "assign") for m in re.finditer(plain["assign"], text) if len(m[2]) >= 12]
        want += [(m.start(), m.end(), k) for k, n in (("access", 18), ("hex", 16)) for m in re.finditer(plain[k], text) if len(m[0]) >= n]
        assert sorted(secret_scan.base_spans(text)) == sorted(want)


def test_secret_lexing():
    text = 'K = "aB3dE5gH7jK9lM1n"\nq=K\ndb_password := q\nx: hello\nuser: "bob the builder"\nclient_secret => zz19ASDkq112ll\npassword: "changeme"\ncolour = "aB3dE5gH7jK9lM1nXX"'
    assert [text[s:e] for s, e in secret_scan.lexed_spans(text)] == ["aB3dE5gH7jK9lM1n", "zz19ASDkq112ll"]
    base, every = secret_scan.scan('{"password": "Xk29_fjQ0skd77"}')
    assert base == every == [(2, 28, "assign")]         # the literal lies in the base span


# -- lines ------------------------------------------------------------------------------------------

def plain_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance():
    rnd = random.Random(11)
    for _ in range(4000):
        a = "".join(rnd.choice("abé") for _ in range(rnd.randint(0, 12)))
        b = edited(rnd, a, rnd.randint(0, 4), "abé")
        for most in (1, 2, 3):
            assert line_dedup.edit_distance(a, b, most) == min(plain_edits(a, b), most + 1)


def lines_gone(docs):
    """``{id: numbers}`` of the lines that go, by comparing all pairs."""
    rows = [(d, n, x) for d, t in docs.items() if t is not None for n, x in enumerate(t.split("\n")) if x.strip()]
    want = Groups()
    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = rows[i][2], rows[j][2]
        most = min(2, max(0, min(len(a), len(b)) // 8 - 1))
        if a == b or (most and abs(len(a) - len(b)) <= most and plain_edits(a, b) <= most):
            want.join(i, j)
    gone = {}
    for i, (d, n, _) in enumerate(rows):       # rows are in the order of documents and lines
        if want.find(i) != i:
            gone.setdefault(d, []).append(n)
    return gone


@pytest.mark.parametrize("block_rows", [2048, 3])
def test_lines(spark, block_rows):
    rnd = random.Random(12)
    base = ["".join(rnd.choice("abcdefgh é") for _ in range(rnd.randint(1, 60))) for _ in range(50)]
    docs = {d: "\n".join(edited(rnd, rnd.choice(base), rnd.choice([0, 0, 1, 1, 2, 3])) for _ in range(rnd.randint(0, 6))) for d in range(120)}
    docs |= {500: None, 501: "", 502: "x\n \ny", 503: "x\n\ny"}
    gone = lines_gone(docs)
    assert gone[503] == [0, 2]
    got = {r["id"]: list(r["lines"]) for r in line_dedup.dropped_lines(frame(spark, docs), block_rows=block_rows).collect()}
    assert got == gone
    if block_rows == 3:
        text = {r["doc_id"]: r["text"] for r in line_dedup.line_dedup(frame(spark, docs)).collect()}
        assert text == {d: t if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone.get(d, [])) for d, t in docs.items()}


def test_lines_of_every_length(spark):
    rnd = random.Random(21)
    base = ["".join(rnd.choice("abcdefgh é") for _ in range(n)) for n in range(1, 41) for _ in range(2)]
    lines = [edited(rnd, x, n) for x in base for n in (0, 0, 1, 2, 3)] + ["line abc"] * 5 + ["some thing short", "some thing shart"]
    docs = {d: x for d, x in enumerate(lines)}
    got = {r["id"]: list(r["lines"]) for r in line_dedup.dropped_lines(frame(spark, docs)).collect()}
    assert got == lines_gone(docs) and len(docs) - 1 in got


def test_long_lines_are_dealt_by_bytes(spark):
    rnd = random.Random(22)
    long = "".join(rnd.choice("abcdefgh é") for _ in range(40_000))
    docs = {d: edited(rnd, long, 1) for d in range(1, 9)} | {0: long, 9: long[:20_000]}
    got = {r["id"] for r in line_dedup.dropped_lines(frame(spark, docs), block_bytes=50_000).collect()}
    assert got == set(range(1, 9))


def test_rows_of_one_id_are_documents_of_their_own(spark):
    first, second, third = "a line that two of the rows have", "only one row has this one, at the same place", "and this one is by itself as well"
    rows = [(i, t) for i in (None, 7) for t in (f"{first} {i}\n{third} {i}", f"{second} {i}\n{first} {i}")] * 2
    got = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 8
    for i in (None, 7):
        texts = [r["text"].split("\n") for r in got if r["doc_id"] == i]
        assert sorted(x for t in texts for x in t if not x.startswith(first)) == sorted([f"{second} {i}", f"{third} {i}"] * 2)
        assert sum(t.count(f"{first} {i}") for t in texts) == 2        # the copies of the row whose line stays
    assert sorted(line_dedup.line_counts(spark.createDataFrame(rows, "doc_id long, text string")).select("n_removed").toPandas()["n_removed"]) == [0] * 4 + [1] * 4


def test_a_frequent_line_leaves_a_task_once():
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["a line that is frequent in this table\n" * 60_000, "a line that is frequent in this table\nand another line"])], ["id", "text"])
    got = [row for out in line_dedup._signatures(2, 8)(iter([batch, batch])) for row in zip(*(c.to_pylist() for c in out.columns))]
    assert len(got) == len(set(got)) and len({name for _, name in got}) == 2
    recent = line_dedup.Recent(2)
    assert [recent.unseen(list(x)).tolist() for x in ("aab", "ca", "d", "a", "c")] == [[0, 2], [0], [0], [0], []]


@pytest.mark.parametrize("batch_rows", [1000, 30_000])
def test_partners_of_a_frequent_line(batch_rows):
    # B is no partner of the linked A and C, and lies between them in more rows than a block
    a, b, c = 1 << 40, (2 << 40) | 0x55555555, 3 << 40
    rows = [(5, a), *[(5, b)] * 20_000, (5, c), (6, a), (6, c), (7, b)]
    batches = [pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows[i:i + batch_rows])], ["key", "name"]) for i in range(0, len(rows), batch_rows)]
    got = [row for out in line_dedup._partners(2)(batches) for row in zip(*(col.to_pylist() for col in out.columns))]
    assert sorted(got) == [(5, a), (5, c), (6, a), (6, c)]


def test_partners_of_a_large_key():
    names = [(i << 32) | (0x55555555 if i % 2 else 0) for i in range(5000)]
    rows = [(4, 1), (4, 2)] + [(5, n) for n in names for _ in range(3)] + [(6, 7)]
    batches = [pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows[i:i + 900])], ["key", "name"]) for i in range(0, len(rows), 900)]
    got = [row for out in line_dedup._partners(2)(batches) for row in zip(*(col.to_pylist() for col in out.columns))]
    assert sorted(got) == [(4, 1), (4, 2)] + [(5, n) for n in names]


# -- toxicity -----------------------------------------------------------------------------------------

def test_ordinal():
    rnd = random.Random(13)
    common = ["".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(300)]
    samples = []
    for i in range(900):
        grade = i % 3
        words = [rnd.choice(common) for _ in range(60)] + ["rude"] * (grade >= 1) + ["vile"] * (grade == 2)
        rnd.shuffle(words)
        samples.append((" ".join(words).encode(), grade))
    model = toxicity.train(samples)
    assert (np.diff(model["cuts"]) > 0).all()
    value, p = toxicity.severity(model, [t for t, _ in samples] + [b""])
    grades = np.array([g for _, g in samples])
    assert np.allclose(p.sum(axis=1), 1) and value[-1] == 0
    assert [value[:-1][grades == g].mean() for g in range(3)] == sorted(value[:-1][grades == g].mean() for g in range(3))
    assert ((value[:-1] >= model["cut"]) == (grades > 0)).mean() > 0.97


def test_toxicity_held_out(spark, sf_small):
    sf = sf_small.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = {r["id"]: r for r in toxicity.score(docs, toxicity.fit(docs, labels.where("doc_id % 2 = 0"))).collect()}
    held = [(got[r["doc_id"]]["toxic"], r["toxic"] == 1) for r in labels.where("doc_id % 2 = 1").collect()]
    assert np.mean([a == b for a, b in held]) > 0.95
    assert sum(a and not b for a, b in held) <= 0.01 * len(held)


# -- personal data ------------------------------------------------------------------------------------

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_pii(text):
    def luhn(d):
        return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),
                    "card": lambda: 14 <= len(d) <= 19 and luhn(d), "phone": lambda: 10 <= len(d) <= 15}[kind]():
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    spans = [x[2] for x in sorted(out)]
    return [sum(s.startswith(k + ":") for s in spans) for k in PLAIN], hashlib.sha256(",".join(spans).encode()).hexdigest(), set(spans)


def test_pii(spark, sf_small):
    rnd = random.Random(14)
    odd = ["a@b.c+d@e.f", "1.2.3.4.5.6.7.8.9", "4111 1111 1111 1111", "🙂 4111-1111-1111-1111x", "+1 (555) 123-4567", "a" * 3000 + "@x.y", "1 " * 400,
           "1." * 300, "x@y" + ".z" * 3000, "+1" + " " * 2000 + "2", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5", "001.002.003.004", "1.2.3.0000000000000000004", None, ""]
    odd += ["".join(rnd.choice("ab1234567890.@+-() %é🙂\n9") for _ in range(rnd.randint(5, 120))) for _ in range(1500)]
    docs = texts_of(spark, sf_small) | {10_000 + i: t for i, t in enumerate(odd)}
    df = frame(spark, docs)
    for model in (None, pii.fit(df)):
        for r in pii.find_pii(df, model).collect():
            counts, digest, spans = plain_pii(docs[r["id"]])
            assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]] == [*counts, digest], docs[r["id"]]
            assert spans <= set(r["spans"].split(",")) | {""} and r["n_added"] == len(set(r["spans"].split(",")) - {""}) - len(spans)
    nodes = pii.find_pii(df, model)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", nodes)


def test_pii_obfuscated(spark, sf_small):
    known = spark.read.parquet(f"{sf_small.replace('0.001', '0.1')}/documents.parquet")
    model = pii.fit(known)
    forms = ["{0} [at] {1} [dot] com", "{0}(at){1}.com", "{0} {{at}} {1} {{dot}} org", "{0}[at]{1}[dot]co[dot]uk"]
    names = ["john", "jane.roe", "m_smith", "k9-unit", "info", "a.b.c", "sales", "peter77"]
    docs, want = {}, {}
    for i, (form, name) in enumerate(itertools.product(forms, names)):
        case = form.format(name, "example" if i % 2 else "my-site")
        docs[i], want[i] = f"please write to {case} for more", f"email:16:{16 + len(case)}"
    docs |= {900: "We met at noon. Then we left at 5.30 and looked at page 7.", 901: "version 1.2.3 of 2024-01-15, see table 12.5"}
    got = {r["id"]: r for r in pii.find_pii(frame(spark, docs), model).collect()}
    found = sum(want[i] in got[i]["spans"].split(",") for i in want)
    assert found >= 0.9 * len(want)     # 32 of 32 when written
    assert got[900]["n_added"] == got[901]["n_added"] == 0


def test_pii_many_matches(spark, monkeypatch):
    """Texts with thousands of matches: base spans as in the plain form, candidates as
    found without blocks, chunks and halving."""
    rnd = random.Random(4)
    forms = ["jo{0}@site{1}.example.org ", "jo{0} [at] site{1} [dot] org; ", "10.{1}.{0}.7 ", "10,1,{1},999 é ", "4111 1111 1111 1111, ", "4111.1111.1111.11{1} ",
             "+49 30 1234 {0}{1}55 ", "call 0049 30 12345 {1}77 日本 ", "no match at all. "]
    docs = {n: "".join(rnd.choice(forms).format(rnd.randrange(300), rnd.randrange(10, 99)) for _ in range(n)) for n in (0, 1, 15, 16, 17, 40, 600, 2500)}
    for r in pii.find_pii(frame(spark, docs), None).collect():
        counts, digest, spans = plain_pii(docs[r["id"]])
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]] == [*counts, digest]
        assert set(r["spans"].split(",")) - {""} == spans

    def candidates():
        return sorted(map(str, pii._with_spans(frame(spark, docs), "doc_id", "text").select("id", "candidates").collect()))
    new = candidates()
    monkeypatch.setattr(pii, "BLOCK", 1 << 30)
    monkeypatch.setattr(pii, "MANY", 1 << 30)
    assert new == candidates()
