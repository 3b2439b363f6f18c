"""Contiguous shards of near-equal bytes by prefix sums over partition totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.text import partitions, stored

ROW_BYTES = 8


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32) of every document: UTF-8 bytes plus ``ROW_BYTES``; a null text has none."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )


def contiguous(rows: DataFrame, shards: int = 24) -> DataFrame:
    """Adds ``shard`` and ``slot`` to rows with ``doc_id``, ``size`` and ``text_crc32``.

    Rows stand in the order of (doc_id, size, text_crc32), nulls first, rows that repeat in any
    order. A row goes to the shard that the byte at its start falls in when all bytes are cut at
    equal targets, so a shard is off its target by less than one row at either end. An empty
    table gives no rows.

    The rows are dealt into ranges once and written; each range's total is one row, and the sums
    of the ranges before are added to sums within a range. A tie-breaker splits repeated rows, so
    that no range depends on one key.
    """
    spark = rows.sparkSession
    order = ["doc_id", "size", "text_crc32", "tie"]
    tied = stored(rows.select("doc_id", "size", "text_crc32", F.monotonically_increasing_id().alias("tie")), "sizes")
    ranged = stored(
        tied.repartitionByRange(partitions(spark), *order).select("*", F.spark_partition_id().alias("range")), "ranges"
    )
    totals = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    all_ranges = Window.partitionBy()
    totals = stored(
        totals.select(
            "range",
            F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
            F.sum("bytes").over(all_ranges).alias("all_bytes"),
        ),
        "totals",
    )
    inside = Window.partitionBy("range").orderBy(*order)
    placed = (
        ranged.join(totals, "range")
        .withColumn("start", F.col("bytes_before") + F.sum("size").over(inside) - F.col("size"))
        .withColumn("row", F.col("rows_before") + F.row_number().over(inside) - 1)
        .withColumn("shard", F.floor(F.col("start") * shards / F.col("all_bytes")).cast("int"))
    )
    placed = stored(placed.select("doc_id", "size", "text_crc32", "shard", "row"), "placed")
    firsts = placed.groupBy("shard").agg(F.min("row").alias("first"))
    return placed.join(firsts, "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("row") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    return contiguous(sized(docs), shards)
