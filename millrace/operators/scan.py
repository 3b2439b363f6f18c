"""Ordered scans (fill, running sum) that split a key's history into slices.

A plain ``partitionBy(key)`` window puts the whole history of a key into one task. Here a key is
cut along its ordering axis into slices; each slice is scanned on its own, one summary row per
slice is scanned next, and the summary is added to the rows of the slice. A task sorts one slice,
or the summaries of one key, whose number depends on the length of the axis and not on the
number of rows. The order must be unique within a key: for tables kept by machine and time that
bounds a slice by its width. Collapse repeated keys first (``upsert.last_per_key``), which combines
copies on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import written

SLICE = "_slice"


def micros(ts: Column | str) -> Column:
    column = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(column.cast("timestamp"))


def time_slice(ts: Column | str, seconds: int) -> Column:
    return F.floor(micros(ts) / F.lit(seconds * 1_000_000)).cast("long")


def value_slice(value: Column | str, width: float) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return F.floor(column / F.lit(float(width))).cast("long")


def cut_slices(df: DataFrame, by: Sequence[str], value: str, name: str, slices: int = 64, accuracy: int = 10_000) -> DataFrame:
    """``df`` with the number of its slice of ``value`` within ``by`` as ``name``: about equally many rows in each slice.

    The cuts come from one pass with a mergeable sketch, so slices stay even where the values crowd; equal values
    share a slice. Rows without value or key are in slice 0. Scans over the slices stay exact, whatever the cuts.
    ``df`` is read twice; the cuts, one row per key, are written first so that Spark joins them by their real size.
    """
    shares = [i / slices for i in range(1, slices)]
    cuts = written(df.groupBy(*by).agg(F.percentile_approx(value, shares, accuracy).alias("_cuts")), "cuts")
    rows = df.join(cuts, list(by), "left") if by else df.withColumn("_cuts", cuts.scalar())
    below = F.when(F.col(value).isNotNull() & F.col("_cuts").isNotNull(), F.size(F.filter("_cuts", lambda c: c < F.col(value))))
    return rows.select(*df.columns, F.coalesce(below, F.lit(0)).cast("long").alias(name))


@dataclass(frozen=True)
class Fill:
    """Take the nearest non-null ``source`` at or before the row (``backward``: at or after)."""

    name: str
    source: str
    backward: bool = False


def _join_slices(rows: DataFrame, summary: DataFrame, by: Sequence[str]) -> DataFrame:
    return rows.join(summary, [*by, SLICE], "left")


def fill(df: DataFrame, by: Sequence[str], order: Sequence[str], slice_: Column, fills: Sequence[Fill]) -> DataFrame:
    """Add one filled column per entry of ``fills``; ``by`` + ``order`` must be unique and non-null."""
    rows = df.withColumn(SLICE, slice_)
    position = F.struct(*order)
    ahead = Window.partitionBy(*by, SLICE).orderBy(*[F.col(c).asc() for c in order])
    behind = Window.partitionBy(*by, SLICE).orderBy(*[F.col(c).desc() for c in order])
    inside, edges, outside = {}, [], []
    earlier = Window.partitionBy(*by).orderBy(F.col(SLICE).asc()).rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*by).orderBy(F.col(SLICE).desc()).rowsBetween(Window.unboundedPreceding, -1)
    for f in fills:
        source = F.col(f.source)
        frame = (behind if f.backward else ahead).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        inside[f"_in_{f.name}"] = F.last(source, ignorenulls=True).over(frame)
        nearest = F.min_by if f.backward else F.max_by
        edges.append(nearest(source, F.when(source.isNotNull(), position)).alias(f"_edge_{f.name}"))
        outside.append(
            F.last(f"_edge_{f.name}", ignorenulls=True).over(later if f.backward else earlier).alias(f"_out_{f.name}")
        )
    summary = rows.groupBy(*by, SLICE).agg(*edges).select(*by, SLICE, *outside)
    joined = _join_slices(rows.withColumns(inside), summary, by)
    keep = [F.col(c) for c in df.columns if c not in {f.name for f in fills}]
    filled = [F.coalesce(f"_in_{f.name}", f"_out_{f.name}").alias(f.name) for f in fills]
    return joined.select(*keep, *filled)


def running_sum(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    slice_: Column,
    name: str,
    value: Column | None = None,
    descending: bool = False,
    total: str | None = None,
) -> DataFrame:
    """Add the inclusive running sum of ``value`` (default: running row number) as ``name``.

    ``total`` names a further column for the sum over the whole key.
    """
    rows = df.withColumn(SLICE, slice_).withColumn("_value", F.lit(1).cast("long") if value is None else value)

    def direction(c: str) -> Column:
        return F.col(c).desc() if descending else F.col(c).asc()

    inner = Window.partitionBy(*by, SLICE).orderBy(*[direction(c) for c in order])
    inner = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    outer = Window.partitionBy(*by).orderBy(direction(SLICE)).rowsBetween(Window.unboundedPreceding, -1)
    summary = rows.groupBy(*by, SLICE).agg(F.sum("_value").alias("_total"))
    whole = F.sum("_total").over(Window.partitionBy(*by))
    sums = [F.sum("_total").over(outer).alias("_before"), *([whole.alias(total)] if total else [])]
    summary = summary.select(*by, SLICE, *sums)
    joined = _join_slices(rows.withColumn("_inside", F.sum("_value").over(inner)), summary, by)
    upto = F.col("_inside") + F.coalesce(F.col("_before"), F.lit(0))
    kept = [F.col(c) for c in df.columns if c != name]
    return joined.select(*kept, upto.alias(name), *([total] if total else []))
