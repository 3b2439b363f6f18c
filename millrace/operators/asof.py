"""Nearest-in-time match within a tolerance, for any number of feeds at once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.scan import SLICE, micros, running_sum, time_slice


@dataclass(frozen=True)
class Feed:
    """A table to match against: ``columns`` are taken from its row nearest in time.

    ``tie`` is a numeric column that decides between rows of the same instant (the smallest wins).
    """

    name: str
    rows: DataFrame
    tolerance_s: int
    columns: Sequence[str]
    tie: str


def matches_within(
    keys: DataFrame, feeds: Sequence[Feed], by: Sequence[str], ts: str = "ts", slice_s: int | None = None
) -> DataFrame:
    """One row per distinct ``(by, ts)`` of ``keys`` with a struct column per feed (null: no match).

    No candidate pairs are formed. Each key's time line is cut into slices; a slice holds the
    instants of keys and feeds that fall in it, and the first or last feed row of each other slice
    within the tolerance. Fills in both directions bring the feed rows before and after to each
    key, and the nearer one within the tolerance stays, the earlier one on a tie. Copies of an
    instant collapse in the map-side aggregation, so a repeated key costs one row. A slice is as
    wide as the largest tolerance; dense feeds may be cut finer with ``slice_s``.
    """
    width = slice_s or max(feed.tolerance_s for feed in feeds)
    marks = keys.select(*by, ts, time_slice(ts, width).alias(SLICE), F.lit(True).alias("_asked"))
    for feed in feeds:
        payload = F.struct(F.col(ts).alias("_at"), *feed.columns)
        rows = feed.rows.select(
            *by, ts, time_slice(ts, width).alias(SLICE), F.col(feed.tie).alias("_tie"), payload.alias("_row")
        )
        rows = rows.unionByName(_edges(rows, by, ts, -(-feed.tolerance_s // width)))
        rows = rows.withColumnsRenamed({"_tie": f"_tie_{feed.name}", "_row": feed.name})
        marks = marks.unionByName(rows, allowMissingColumns=True)
    firsts = [F.min_by(f.name, f"_tie_{f.name}").alias(f.name) for f in feeds]
    marks = marks.where(_present(by, ts)).groupBy(*by, SLICE, ts).agg(F.max("_asked").alias("_asked"), *firsts)
    ahead = Window.partitionBy(*by, SLICE).orderBy(F.col(ts).asc())
    behind = Window.partitionBy(*by, SLICE).orderBy(F.col(ts).desc())
    for prefix, window in (("_prev_", ahead), ("_next_", behind)):
        frame = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        marks = marks.withColumns({prefix + f.name: F.last(f.name, ignorenulls=True).over(frame) for f in feeds})
    return marks.where("_asked").select(*by, ts, *[_nearer(feed, ts).alias(feed.name) for feed in feeds])


def _edges(rows: DataFrame, by: Sequence[str], ts: str, reach: int) -> DataFrame:
    """The last row of each slice, offered to the ``reach`` slices after it, and the first to those before."""
    row = F.struct(F.col(ts), "_tie", "_row")
    ends = rows.where(_present(by, ts)).groupBy(*by, SLICE).agg(
        F.min_by(row, F.struct(F.col(ts), F.col("_tie"))).alias("first"),
        F.max_by(row, F.struct(F.col(ts), -F.col("_tie"))).alias("last"),
    )
    offers = [F.struct((F.col(SLICE) - n).alias(SLICE), F.col("first").alias("row")) for n in range(1, reach + 1)]
    offers += [F.struct((F.col(SLICE) + n).alias(SLICE), F.col("last").alias("row")) for n in range(1, reach + 1)]
    offered = ends.select(*by, F.explode(F.array(*offers)).alias("offer"))
    return offered.select(*by, f"offer.row.{ts}", f"offer.{SLICE}", "offer.row._tie", "offer.row._row")


def nearest_within(
    left: DataFrame,
    feeds: Sequence[Feed],
    by: Sequence[str],
    ts: str = "ts",
    required: Sequence[str] = (),
    slice_s: int | None = None,
    matched_at: bool = False,
) -> DataFrame:
    """``left`` with the columns of each feed's nearest row; left rows stay unless a feed is ``required``."""
    found = matches_within(left, feeds, by, ts, slice_s)
    for name in required:
        found = found.where(F.col(name).isNotNull())
    out = left.join(found, [*by, ts], "inner" if required else "left")
    picked = []
    for feed in feeds:
        if matched_at:
            picked.append(F.col(f"{feed.name}._at").alias(f"{feed.name}_ts"))
        picked += [F.col(f"{feed.name}.{c}").alias(c) for c in feed.columns]
    return out.select(*left.columns, *picked)


def nearest_by_rank(left: DataFrame, feed: Feed, by: Sequence[str], left_id: str, ts: str = "ts") -> DataFrame:
    """The same match as a ranking: one row per ``left_id`` that has a match.

    The feed's instants are numbered within each key, and each left row learns how many of them lie at or before it;
    the rows of that number and the next are its candidates, joined by number and ranked by distance. So a left row has
    two candidates at most, however dense the feed. Kept as the independent form that the tests compare
    ``nearest_within`` with.
    """
    here = _present(by, ts)
    row = F.struct(F.col(ts).alias("_at"), F.col(feed.tie).alias("_tie"), *feed.columns)
    asked = left.where(here).select(*by, F.col(ts), F.col(left_id))
    offered = feed.rows.where(here).select(*by, F.col(ts), row.alias("_row"))
    marks = asked.select(*by, ts).unionByName(offered, allowMissingColumns=True)
    first = F.min_by("_row", F.when(F.col("_row").isNotNull(), F.struct("_row._tie")))
    marks = marks.groupBy(*by, ts).agg(first.alias("_row"))
    numbered = running_sum(marks, by, [ts], time_slice(ts, feed.tolerance_s), "_number", F.col("_row").isNotNull().cast("long"))
    near = asked.join(numbered.select(*by, ts, "_number"), [*by, ts])
    near = near.withColumn("_number", F.explode(F.array(F.col("_number"), F.col("_number") + 1)))
    pairs = near.join(numbered.where("_row IS NOT NULL").select(*by, "_number", "_row"), [*by, "_number"])
    pairs = pairs.withColumn("_gap", F.abs(micros(ts) - micros("_row._at"))).where(F.col("_gap") <= feed.tolerance_s * 1_000_000)
    order = F.struct("_gap", "_row._at", "_row._tie")
    best = pairs.groupBy(left_id).agg(F.min_by(F.struct(*by, ts, "_row"), order).alias("_best"))
    kept = [F.col(f"_best.{c}").alias(c) for c in (*by, ts)]
    return best.select(left_id, *kept, F.col("_best._row._at").alias(f"{feed.name}_ts"), *[F.col(f"_best._row.{c}").alias(c) for c in feed.columns])


def _present(by: Sequence[str], ts: str) -> Column:
    present = F.col(ts).isNotNull()
    for c in by:
        present = present & F.col(c).isNotNull()
    return present


def _nearer(feed: Feed, ts: str) -> Column:
    limit = F.lit(feed.tolerance_s * 1_000_000)
    back = micros(ts) - micros(F.col(f"_prev_{feed.name}._at"))
    ahead = micros(F.col(f"_next_{feed.name}._at")) - micros(ts)
    back_fits, ahead_fits = F.coalesce(back <= limit, F.lit(False)), F.coalesce(ahead <= limit, F.lit(False))
    take_back = back_fits & (~ahead_fits | (back <= ahead))
    return F.when(take_back, F.col(f"_prev_{feed.name}")).when(ahead_fits, F.col(f"_next_{feed.name}"))
