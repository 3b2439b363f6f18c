"""Nearest match on streams: one aggregation per machine and time window, then a search in its sorted rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.asof import Feed
from millrace.operators.scan import micros, time_slice


def stream_nearest(left: DataFrame, feed: Feed, columns: Sequence[str], delay: str = "1 hour") -> DataFrame:
    """Rows of ``left`` (``event_id``, ``machine_id``, ``ts`` and ``columns``) with the nearest feed row.

    See ``matched``; equal rows of ``left`` leave as one.
    """
    found = matched(left, [feed], columns, delay)
    return found.select(
        "event_id", "machine_id", "ts", *columns, F.col(f"_best_{feed.name}._at").alias(f"{feed.name}_ts"),
        *[F.col(f"_best_{feed.name}.{c}").alias(c) for c in feed.columns],
    )


def matched(left: DataFrame, feeds: Sequence[Feed], columns: Sequence[str], delay: str) -> DataFrame:
    """Distinct rows of ``left`` with the nearest row of each feed as the struct ``_best_<feed>``.

    No pairs are formed. Time is cut into slices of the largest tolerance, and a window is a slice with its neighbours.
    A window holds the left and feed rows of its slice, and of the slices before and after only the last and the first
    feed row. When the watermark passes its end, each left row finds the feed rows around it by a binary search, and the
    nearer one within the tolerance stays, the earlier one on a tie. So a left row leaves when the watermark has passed
    it by one to two slices; state is keyed by machine and window and holds each left row once.
    """
    width = max(f.tolerance_s for f in feeds)
    asked = left.select("machine_id", F.col("ts").alias("_time"), F.struct("ts", "event_id", *columns).alias("_asked")).withWatermark("_time", delay)
    offered = [
        f.rows.where(F.col("machine_id").isNotNull()).select(
            "machine_id", F.col("ts").alias("_time"),
            F.struct(F.col("ts").alias("_at"), F.col(f.tie).alias("_tie"), F.struct(F.col("ts").alias("_at"), *f.columns).alias("_row")).alias(f"_row_{f.name}"),
        ).withWatermark("_time", delay)
        for f in feeds
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), offered, asked)
    rows = rows.withColumn("_window", F.window("_time", f"{3 * width} seconds", f"{width} seconds"))
    place = time_slice("_time", width) - time_slice("_window.start", width) - 1  # -1: the slice before, 0: its own, 1: after
    rows = rows.withColumn("_place", place).where((F.col("_place") == 0) | F.col("_asked").isNull())
    held = rows.groupBy("machine_id", "_window").agg(F.collect_set("_asked").alias("_asked"), *[a for f in feeds for a in _around(f.name)])
    held = held.where(F.size("_asked") > 0)
    held = held.select("machine_id", "_asked", *[_instants(f.name).alias(f"_rows_{f.name}") for f in feeds])
    found = held.select("machine_id", F.explode(F.transform("_asked", lambda a: F.struct(
        a.alias("asked"), *[_nearest(F.col(f"_rows_{f.name}"), a["ts"], f.tolerance_s).alias(f.name) for f in feeds]
    ))).alias("_found"))
    return found.select(
        *[F.col(f"_found.asked.{c}").alias(c) for c in ("event_id", "ts", *columns)], "machine_id",
        *[F.col(f"_found.{f.name}._row").alias(f"_best_{f.name}") for f in feeds],
    )


def _around(name: str) -> list[Column]:
    """The feed rows of a slice, the last one before it and the first one after; of one instant the smallest tie counts."""
    row, at, tie = F.col(f"_row_{name}"), F.col(f"_row_{name}._at"), F.col(f"_row_{name}._tie")
    here = row.isNotNull()
    return [
        F.max_by(row, F.when(here & (F.col("_place") == -1), F.struct(at, tie.isNull(), -tie))).alias(f"_before_{name}"),
        F.sort_array(F.collect_list(F.when(F.col("_place") == 0, row))).alias(f"_rows_{name}"),
        F.min_by(row, F.when(here & (F.col("_place") == 1), F.struct(at, tie))).alias(f"_after_{name}"),
    ]


def _instants(name: str) -> Column:
    """The rows of ``_around`` in order of time, one per instant."""
    rows = F.col(f"_rows_{name}")
    first = F.filter(rows, lambda r, i: (i == 0) | (F.get(rows, i - 1)["_at"] != r["_at"]))
    return F.array_compact(F.concat(F.array(f"_before_{name}"), first, F.array(f"_after_{name}")))


def _nearest(rows: Column, ts: Column, tolerance_s: int) -> Column:
    """The entry of ``rows`` (in order of ``_at``) nearest to ``ts`` within the tolerance, or null."""
    steps = F.sequence(F.lit(1), F.length(F.bin(F.size(rows).cast("long"))))

    def halved(span: Column, _: Column) -> Column:
        middle = F.shiftright(span["low"] + span["high"], 1)
        below = (span["low"] < span["high"]) & (F.get(rows, middle)["_at"] < ts)
        return F.struct(F.when(below, middle + 1).otherwise(span["low"]).alias("low"), F.when(below, span["high"]).otherwise(middle).alias("high"))

    def chosen(span: Column) -> Column:
        limit = F.lit(tolerance_s * 1_000_000)
        before, after = F.get(rows, span["low"] - 1), F.get(rows, span["low"])
        back, ahead = micros(ts) - micros(before["_at"]), micros(after["_at"]) - micros(ts)
        back_fits, ahead_fits = F.coalesce(back <= limit, F.lit(False)), F.coalesce(ahead <= limit, F.lit(False))
        return F.when(back_fits & (~ahead_fits | (back <= ahead)), before).when(ahead_fits, after)

    return F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.size(rows).alias("high")), halved, chosen)
