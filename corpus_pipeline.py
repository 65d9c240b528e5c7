"""Corpus pipeline: quality, near duplicates, repeated passages, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet and read again as the next stage's docs. All but the last return the
columns of documents. No stage's result can be stated in SQL (hashed n-grams,
hash-based components, byte strings, a piece model), so ``ORACLE_SQL`` is None
and tests compare ``run`` with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kiln.llm import op01_quality, op03_near_dedup, op07_pieces, op08_decontaminate, op10_suffix_dedup
from kiln.llm.frames import stored
from kiln.session import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio against documents labelled good."""
    return op01_quality.quality_filter(docs, table(spark, sf_dir, "labels").filter("quality = 1"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group linked at 0.8 on 5-word shingles."""
    return op03_near_dedup.near_dedup(docs, shingle=5, percent=80)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the bytes of 200-byte strings that occur more than once (shorter than nearly every passage of 50 words)."""
    return op10_suffix_dedup.suffix_dedup(docs, length=200)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no 10-word window of a benchmark item occurs."""
    return op08_decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and the piece ids of the text."""
    return op07_pieces.encoded(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontaminate", decontaminate),
    ("sentencepiece", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other, from the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if k == 0 else stored(docs), sf_dir)
    return docs
