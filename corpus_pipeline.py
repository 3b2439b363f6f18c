"""From documents to packed training sequences: five stages, each reading what the one before has written.

Rows that a stage rejects go: texts that the rules find bad, all but the first of near-duplicate
documents, repeated passages (and texts that lose all words with them), documents that hold a
benchmark item. The last stage returns the pieces and where they are packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontaminate, neardup, packing, phrases, quality
from millrace.llm.text import documents, release, small_batches, stored


def prepared(spark: SparkSession, docs: DataFrame) -> None:
    """Small batches of texts; the working tables of the stage before go, as its output has been written."""
    small_batches(spark)
    release(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark, docs)
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark, docs)
    return neardup.keep_first(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark, docs)
    return phrases.cut_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark, docs)
    return decontaminate.drop_leaks(docs, documents(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark, docs)
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_duplicates),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]
ORACLE_SQL = None  # rules' weights, tokens and packing are beyond SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline")
    return docs
