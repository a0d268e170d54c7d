"""Nulls, empty and very long texts, ties and repeated rows, empty tables and
extra columns with clashing names, for every operator and stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tierwise.llm import decontamination, embedding, language, line_dedup, packing, pii, secret_scan, simhash, substring_dedup, toxicity
from tierwise.llm.queries import word_tokenizer

LONG = "word other thing " * 20_000
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id long, fp long, key string, component_id long, lines string, "
          "__gone_id long, __gone_lines string, __place long, __word long, __bits long, first long, spans string, length int, digest binary, name string")
TEXTS = {1: "one two three four\nand a line that is long enough to count", 2: None, 3: "", 4: LONG, 5: "12 !!", 6: "one two three four\nand a line that is long enough to count"}


@pytest.fixture(scope="module")
def docs(spark):
    def row(i, text):
        return (i, text, "en" if i and i % 2 else None, "s", 1, 7, 7, "k", 7, "l", 7, "g", 7, 7, 7, 7, "x", 7, b"d", "n")
    rows = [row(i, t) for i, t in TEXTS.items()] + [row(1, TEXTS[1]), row(None, "a text without an id, which counts as well")]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def bench(spark):
    return spark.createDataFrame([(1, "a passage of the benchmark that is long enough to be told apart"), (2, None), (None, "x"), (3, "")], "item_id long, text string")


OPERATORS = {
    "pii": lambda s, d: pii.find_pii(d, pii.fit(d)),
    "simhash": lambda s, d: simhash.components(d),
    "substring": lambda s, d: substring_dedup.substring_dedup(d),
    "language": lambda s, d: language.identify(d, language.fit(d)),
    "secret": lambda s, d: secret_scan.secret_scan(d),
    "lines": lambda s, d: line_dedup.line_counts(d),
    "toxicity": lambda s, d: toxicity.score(d, toxicity.fit(d, s.createDataFrame([(1, 1, 0), (3, None, 1), (None, 0, 1)], "doc_id long, quality int, toxic int"))),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_document(spark, docs, none, name):
    got = OPERATORS[name](spark, docs).collect()
    assert sorted(r["id"] is None for r in got).count(True) == 1 and len(got) == 8
    assert sorted(r["id"] for r in got if r["id"] is not None) == [1, 1, 2, 3, 4, 5, 6]
    twice = [tuple(map(str, r)) for r in got if r["id"] == 1]
    assert twice[0] == twice[1]
    assert OPERATORS[name](spark, none).collect() == []


def test_defined_values(spark, docs):
    got = {r["id"]: r for r in simhash.components(docs).collect()}
    assert got[2]["fp"] == got[3]["fp"] == 0 and got[3]["component_id"] == 2 and got[6]["component_id"] == 1
    got = {r["id"]: r for r in language.identify(docs, language.fit(docs)).collect()}
    assert [got[i]["lang_pred"] for i in (2, 3, 5)] == ["und"] * 3 and got[2]["score"] == 0
    got = {r["id"]: r for r in line_dedup.line_counts(docs).collect()}
    assert (got[2]["n_lines"], got[3]["n_lines"], got[6]["n_removed"], got[1]["n_removed"]) == (0, 1, 2, 0)
    got = {r["id"]: r for r in substring_dedup.substring_dedup(docs).collect()}
    assert got[4]["n_removed"] == len(LONG) - 99 - 17 + 99 and got[2]["n_bytes"] == 0      # one period of 17 stays


def test_packing(spark, docs, none):
    got = packing.best_fit_packing(docs, word_tokenizer(), capacity=64).collect()
    assert {r["doc_id"] for r in got} == {1, 2, 3, 4, 5, 6, None}
    assert [r["length"] for r in got if r["doc_id"] in (2, 3)] == [1, 1]
    assert packing.best_fit_packing(none, word_tokenizer()).collect() == []


def test_leaks(spark, docs, none):
    assert decontamination.find_leaks(docs, bench(spark)).collect() == []
    assert decontamination.find_leaks(none, bench(spark)).collect() == []
    assert decontamination.find_leaks(docs, bench(spark).limit(0)).collect() == []


def test_vectors(spark):
    schema = "vec_id long, embedding array<float>, label int, n long, vec string, same string"
    inf = float("inf")
    rows = [(1, [1.0, 0.0], 0, 1, "v", "s"), (2, [2.0, 0.0], 0, 1, "v", "s"), (2, [2.0, 0.0], 0, 1, "v", "s"), (3, [1.0, 0.0], 1, 1, "v", "s"), (4, None, 0, 1, "v", "s"),
            (5, [0.0, 0.0], 0, 1, "v", "s"), (6, [1.0, None], 0, 1, "v", "s"), (7, [inf, 1.0], 0, 1, "v", "s"), (8, [1.0, 0.0], None, 1, "v", "s"), (9, [], 0, 1, "v", "s"),
            (10, [1.0, 0.0, 0.0], 0, 1, "v", "s"), (11, [float("nan"), 1.0], 0, 1, "v", "s")]
    got = sorted((r["id"], r["n_links"], r["component_id"], r["kept"]) for r in embedding.embedding_near_dedup(spark.createDataFrame(rows, schema)).collect())
    assert got == [(1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False)] + [(i, 0, i, True) for i in range(3, 12)]
    assert embedding.embedding_near_dedup(spark.createDataFrame([], schema)).collect() == []


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, docs, none, sf_small, name, stage):
    got = stage(spark, docs, sf_small)
    if name != corpus_pipeline.STAGES[-1][0]:
        assert got.columns == docs.columns
        ids = {r["doc_id"] for r in got.select("doc_id").collect()}
        assert ids == {"language_id": {1, 4, 6, None}, "simhash_near_dedup": {1, 2, 4, 5, None}}.get(name, {1, 2, 3, 4, 5, 6, None})
        assert got.where(F.col("__bits") == 7).count() == got.count()
    else:
        assert {r["doc_id"] for r in got.collect()} == {1, 2, 3, 4, 5, 6, None}
    assert stage(spark, none, sf_small).collect() == []
