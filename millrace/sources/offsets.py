"""Where records stand in their topic: identity, and a ledger of what has arrived, is missing or came twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LOG = ["topic", "partition"]
PARTITION_BITS = 12  # of a record id; the offset takes the rest, so up to 4096 partitions and 2**51 records each
BLOCK = 4096  # offsets that one window looks at


def record_id(partition: str = "partition", offset: str = "offset") -> Column:
    """A number that names a record within its topic; in a partition it follows the offset."""
    return F.shiftleft(F.col(offset).cast("long"), PARTITION_BITS).bitwiseOR(F.col(partition).cast("long"))


def arrived(records: DataFrame) -> DataFrame:
    """(topic, partition, block, offset, n): each offset once, with how often it came; those without offset are left out."""
    offsets = records.where(F.col("offset").isNotNull()).groupBy(*LOG, F.col("offset").cast("long").alias("offset"))
    return offsets.agg(F.count(F.lit(1)).alias("n")).withColumn("block", F.floor(F.col("offset") / BLOCK).cast("long"))


def gaps(records: DataFrame) -> DataFrame:
    """(topic, partition, gap_from, gap_to, missing): runs of offsets that lie between arrived ones but did not arrive.

    Offsets are compared with the one before in blocks of ``BLOCK``, and the blocks' ends with one
    another, so no task walks a whole partition.
    """
    seen = arrived(records)
    inside = Window.partitionBy(*LOG, "block").orderBy("offset")
    blocks = Window.partitionBy(*LOG).orderBy("block")
    steps = seen.select(*LOG, F.lag("offset").over(inside).alias("before"), "offset")
    ends = seen.groupBy(*LOG, "block").agg(F.min("offset").alias("offset"), F.max("offset").alias("last"))
    steps = steps.unionByName(ends.select(*LOG, F.lag("last").over(blocks).alias("before"), "offset"))
    found = steps.where(F.col("offset") - F.col("before") > 1)
    return found.select(
        *LOG, (F.col("before") + 1).alias("gap_from"), (F.col("offset") - 1).alias("gap_to"),
        (F.col("offset") - F.col("before") - 1).alias("missing"),
    )


def ledger(records: DataFrame, ends: DataFrame) -> DataFrame:
    """One row per partition of ``ends`` (topic, partition, end_offset: the one that the broker writes next).

    ``lag`` counts what the broker has beyond the last arrived offset; a partition of which nothing
    arrived has nulls but for ``records``, ``repeated`` and ``lag``.
    """
    seen = arrived(records).groupBy(*LOG).agg(
        F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"), F.sum("n").alias("records"),
        F.sum(F.col("n") - 1).alias("repeated"), F.count(F.lit(1)).alias("distinct_records"),
    )
    span = F.col("last_offset") - F.col("first_offset") + 1
    return ends.join(seen, LOG, "left").select(
        *LOG, "first_offset", "last_offset", F.coalesce("records", F.lit(0)).alias("records"), F.coalesce("repeated", F.lit(0)).alias("repeated"),
        (span - F.col("distinct_records")).alias("missing"), (F.col("end_offset") - 1 - F.coalesce("last_offset", F.lit(-1))).alias("lag"),
    )
