"""Corpus pipeline: the stages in order, each over what the one before kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; :func:`run`
writes each result as Parquet to the shared folder and reads it again, so a lost
executor costs one stage's tasks and never the stages before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierwise.llm import decontamination, language, line_dedup, packing, simhash
from tierwise.llm.common import read_table, written
from tierwise.llm.queries import word_tokenizer


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a language go (``und``, or no language with
    two fifths of the letters)."""
    return language.language_filter(docs)


def line_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: of lines within two edits the first stays; every document stays."""
    return line_dedup.line_dedup(docs, max_edits=2)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: one document of each group stays."""
    return simhash.simhash_near_dedup(docs, width=3, max_bits=3).select(docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a benchmark passage go."""
    return decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing: one row per piece with its place in a sequence of 2048 tokens."""
    return packing.best_fit_packing(docs, word_tokenizer(), capacity=2048)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_duplicates),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark_passages),
    ("best_fit_packing", packed),
]

#: None: the stages need trained models, iteration and alignment, which SQL cannot
#: express; they are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
