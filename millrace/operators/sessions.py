"""Sessions of a machine: runs of events without a pause."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SESSION = "machine_id string, started timestamp, ended timestamp, events long"


def sessions(rows: DataFrame, pause_s: int = 1800) -> DataFrame:
    """(machine_id, started, ended, events) of each run of events at most ``pause_s`` seconds apart.

    Events of one slot of that width are always in the same session, so they are reduced to their first
    and last instant and their number in the map tasks. Only slots are put in order: their number per
    machine is bounded by the time span, however many events a machine has. An event exactly one pause
    after the last still belongs to it, as in Spark's ``session_window``. Rows without time are left out;
    null is a machine of its own.
    """
    at = F.col("ts").cast("timestamp")
    slot = F.floor(F.unix_micros(at) / F.lit(pause_s * 1_000_000))
    slots = rows.where("ts is not null").groupBy("machine_id", slot.alias("slot")).agg(
        F.min("ts").alias("started"), F.max("ts").alias("ended"), F.count(F.lit(1)).alias("events")
    )
    ordered = Window.partitionBy("machine_id").orderBy("slot")
    before = F.lag("ended").over(ordered)
    waited = F.unix_micros(F.col("started").cast("timestamp")) - F.unix_micros(F.col("before").cast("timestamp"))
    numbered = slots.withColumn("before", before).withColumn("new", F.when(waited > pause_s * 1_000_000, 1).otherwise(0))
    numbered = numbered.withColumn("number", F.sum("new").over(ordered))
    return numbered.groupBy("machine_id", "number").agg(
        F.min("started").alias("started"), F.max("ended").alias("ended"), F.sum("events").alias("events")
    ).drop("number")


def stream_sessions(rows: DataFrame, pause_s: int = 1800, delay: str = "1 hour") -> DataFrame:
    """The same of a stream; a session leaves when the watermark passes its end, later events are dropped."""
    window = F.session_window("ts", f"{pause_s} seconds")
    found = rows.withWatermark("ts", delay).groupBy("machine_id", window.alias("w")).agg(
        F.min("ts").alias("started"), F.max("ts").alias("ended"), F.count(F.lit(1)).alias("events")
    )
    return found.select("machine_id", "started", "ended", "events")
