"""Driver queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.llm import decontamination, embedding, hard_negatives, language, line_dedup, mixing, packing, pii, secret_scan, simhash, substring_dedup, toxicity, whitening
from tierwise.llm.common import read_table


def word_tokenizer() -> str:
    """Path of the public word tokenizer, the same on every machine it is installed on."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added."""
    docs = read_table(spark, sf_dir, "documents")
    return pii.find_pii(docs, pii.fit(docs)).withColumnRenamed("id", "doc_id")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: three-word shingles, 3 bits."""
    found = simhash.components(read_table(spark, sf_dir, "documents"), width=3, max_bits=3)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: strings of 100 bytes."""
    found = substring_dedup.substring_dedup(read_table(spark, sf_dir, "documents"), length=100)
    return found.drop("kept").withColumnRenamed("id", "doc_id")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per piece with its place in a sequence of at most 2048 tokens."""
    return packing.best_fit_packing(read_table(spark, sf_dir, "documents"), word_tokenizer(), capacity=2048)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, start, end, edits of every benchmark passage in a document."""
    found = decontamination.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score, spans of every document."""
    docs = read_table(spark, sf_dir, "documents")
    found = language.identify(docs, language.fit(docs))
    return found.select(F.col("id").alias("doc_id"), language.held_out("id").alias("held_out"), "lang_pred", "score", "spans")


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id, kept: cosine of 0.98 or more within a label."""
    found = embedding.embedding_near_dedup(read_table(spark, sf_dir, "embeddings"), min_cosine=0.98)
    return found.withColumnRenamed("id", "vec_id")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every document."""
    return secret_scan.secret_scan(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed, removed line numbers: lines within 2 edits."""
    return line_dedup.line_counts(read_table(spark, sf_dir, "documents"), max_edits=2).withColumnRenamed("id", "doc_id")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, severity (expected grade), grade, toxic of every document."""
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels"))).withColumnRenamed("id", "doc_id")


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies: weights 5, 2, 1, at most 3 copies."""
    return mixing.mix_plan(read_table(spark, sf_dir, "documents"), weights=(5, 2, 1), max_copies=3).withColumnRenamed("id", "doc_id")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: four
    components.  A deviation beyond a long is null here (the operator's decimal has it)."""
    found = whitening.embedding_whitening(read_table(spark, sf_dir, "embeddings"), components=4, grid=256)
    return found.withColumnRenamed("id", "vec_id").withColumn("deviation", F.col("deviation").try_cast("long"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: anchors
    are every 50th id, 5 positives, 3 negatives of 50 to 95 percent of a positive's score."""
    vectors, vec_id, label = read_table(spark, sf_dir, "embeddings"), F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.hard_negatives(vectors, anchor=vec_id % 50 == 0, label=moved)


QUERIES = {
    "op1_pii": op1_pii,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_decontamination": op5_decontamination,
    "op6_language_id": op6_language_id,
    "op7_embedding_near_dedup": op7_embedding_near_dedup,
    "op8_secret_scan": op8_secret_scan,
    "op9_line_dedup": op9_line_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_source_mix": op11_source_mix,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_hard_negatives": op13_hard_negatives,
}

#: The others need hashes, tokenizers, trained models or byte-level work that SQL
#: lacks; they are tested against brute force.
ORACLE: dict[str, str] = {
    "op7_embedding_near_dedup": """
WITH RECURSIVE v AS (
    SELECT row_number() OVER () AS n, vec_id, label, [CAST(x AS DOUBLE) FOR x IN embedding] AS e FROM embeddings),
ok AS (
    SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
       AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN e IF x <> 0]) > 0),
l AS (
    SELECT a.n AS a, b.n AS b, b.vec_id FROM ok a JOIN ok b ON a.label = b.label AND a.n <> b.n AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
    SELECT n, n AS c, vec_id FROM v
    UNION SELECT r.n, l.b, l.vec_id FROM reach r JOIN l ON l.a = r.c)
SELECT v.vec_id, (SELECT COUNT(*) FROM l WHERE l.a = v.n) AS n_links, m.component_id, v.vec_id = m.component_id AS kept
FROM v JOIN (SELECT n, MIN(vec_id) AS component_id FROM reach GROUP BY n) m ON m.n = v.n""",
    "op11_source_mix": r"""
WITH d AS (
    SELECT doc_id, CASE WHEN source IS NULL THEN 'b' ELSE 'a' || source END AS grp,
           CAST(len(regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+')) AS HUGEINT) AS size,
           COALESCE(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT), -1) AS tie FROM documents),
s AS (
    SELECT grp, CAST(SUM(size) AS HUGEINT) AS source_size,
           CAST([5, 2, 1][(row_number() OVER (ORDER BY grp) - 1) % 3 + 1] AS HUGEINT) AS w FROM d GROUP BY grp),
r AS (
    SELECT *, row_number() OVER o AS k, SUM(source_size) OVER () - 3 * (SUM(source_size) OVER o - source_size) AS rest,
           SUM(w) OVER () - (SUM(w) OVER o - w) AS rest_w
    FROM s WINDOW o AS (ORDER BY source_size * 10 // w, grp ROWS UNBOUNDED PRECEDING)),
f AS (
    SELECT CAST(rest AS HUGEINT) AS num, CAST(rest_w AS HUGEINT) AS den, k FROM r
    WHERE rest * w < 3 * source_size * rest_w ORDER BY k LIMIT 1),
t AS (
    SELECT grp, source_size, COALESCE(r.k < f.k, TRUE) AS capped, CASE WHEN COALESCE(r.k < f.k, TRUE) THEN 3 ELSE r.w * f.num END AS num,
           CASE WHEN COALESCE(r.k < f.k, TRUE) THEN 1 ELSE source_size * f.den END AS den,
           CASE WHEN COALESCE(r.k < f.k, TRUE) THEN CAST(3 * source_size AS DOUBLE)
                ELSE CAST(r.w * f.num AS DOUBLE) / CAST(f.den AS DOUBLE) END AS target
    FROM r LEFT JOIN f ON TRUE),
p AS (
    SELECT d.doc_id, d.size, t.*, CAST('0x' || substr(md5('42:' || grp), 1, 8) AS HUGEINT) * t.den // 4294967296 AS shift,
           CAST(row_number() OVER (PARTITION BY grp ORDER BY d.size, d.tie, d.doc_id NULLS FIRST) - 1 AS HUGEINT) AS k
    FROM d JOIN t USING (grp)),
c AS (
    SELECT *, CASE WHEN source_size > 0 THEN ((k + 1) * num + shift) // den - (k * num + shift) // den ELSE 0 END AS copies FROM p)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(copies * size AS BIGINT) AS taken, CAST(copies AS BIGINT) AS copies
FROM c""",
    "op13_hard_negatives": """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
    SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS alike, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT * FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5),
n AS (
    SELECT p.a, p.b AS positive_id, s.b AS negative_id, p.score AS positive_score, s.score AS negative_score,
           row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS rank
    FROM p JOIN s ON s.a = p.a AND NOT s.alike AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT a AS anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3""",
}
