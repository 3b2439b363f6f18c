"""Registered queries of the operators, each over its whole table, beside their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import (
    alignments, chats, collocations, compression, decontaminate, interpolation, licences, neardup, packing, pages, phrases,
    quality, shards, sql,
)
from millrace.llm.text import documents, small_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(build):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            small_batches(spark)
            return build(spark, folder)

        QUERIES[name] = run
        if oracle is not None:
            SQL[name] = oracle
        return build

    return register


@query("op2_quality_rules", sql.quality_rules())
def _quality(spark, folder):
    return quality.score_documents(documents(spark, folder))


@query("op10_shards", sql.shards())
def _shards(spark, folder):
    return shards.shard_documents(documents(spark, folder))


@query("op6_minhash_dedup", sql.near_duplicates())
def _near_duplicates(spark, folder):
    return neardup.near_duplicates(documents(spark, folder))


@query("op8_substring_dedup", sql.substring_dedup())
def _substring_dedup(spark, folder):
    return phrases.dedup_digests(documents(spark, folder))


@query("op4_best_fit_packing")
def _packing(spark, folder):
    return packing.pack(documents(spark, folder))


@query("op1_decontaminate")
def _decontaminate(spark, folder):
    return decontaminate.leaks(documents(spark, folder), documents(spark, folder, "benchmark"))


@query("op3_quality_classifier")
def _quality_classifier(spark, folder):
    return compression.score_documents(documents(spark, folder), documents(spark, folder, "labels"))


@query("op9_lm_score")
def _lm_score(spark, folder):
    return interpolation.score_documents(documents(spark, folder))


@query("op7_html_text")
def _html_text(spark, folder):
    return pages.extract(documents(spark, folder, "pages"))


@query("op5_license_scan")
def _license_scan(spark, folder):
    return licences.scan(documents(spark, folder))


@query("op11_chat_format", sql.chats())
def _chat_format(spark, folder):
    return chats.format_conversations(chats.probe(documents(spark, folder, "conversations")))


@query("op12_collocations", sql.collocations())
def _collocations(spark, folder):
    return collocations.collocations(documents(spark, folder))


@query("op13_token_alignment")
def _token_alignment(spark, folder):
    return alignments.align_documents(documents(spark, folder))
