"""How well operators and machines work together: share of good units per pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.kpis import ratio, success_rate
from millrace.operators.scan import SLICE, time_slice

PAIR = ["operator_id", "machine_id"]
DEFAULT = 0.5
RECOMMENDED_FROM = 0.8


def from_totals(mes: DataFrame) -> DataFrame:
    good = F.lit(1.0) - ratio(F.sum("defective_units"), F.sum("units_produced"))
    return mes.groupBy(*PAIR).agg(good.alias("affinity"))


def from_last_row(mes: DataFrame) -> DataFrame:
    return mes.groupBy(*PAIR).agg(F.max_by(success_rate(), "ts").alias("affinity"))


def _halvings(n: Column) -> Column:
    return F.pow(F.lit(0.5), n.cast("double"))


def folded(mes: DataFrame, by: list[str] = PAIR, slice_s: int = 86_400) -> DataFrame:
    """For each pair: ``rows`` n and ``gain`` g such that a start value a folds to a / 2^n + g.

    Each row with rate r maps a to (a + r) / 2. These maps compose, so each slice of a pair's
    history is folded alone and the slices are then folded together.
    """
    rated = mes.withColumn("rate", success_rate()).where(F.col("rate").isNotNull())
    rated = rated.withColumn(SLICE, time_slice("ts", slice_s))
    within = Window.partitionBy(*by, SLICE).orderBy(F.col("ts").desc())
    rated = rated.withColumn("_age", F.row_number().over(within))
    slices = rated.groupBy(*by, SLICE).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("rate") * _halvings(F.col("_age"))).alias("gain")
    )
    newer = Window.partitionBy(*by).orderBy(F.col(SLICE).desc()).rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("_newer", F.coalesce(F.sum("rows").over(newer), F.lit(0)))
    return slices.groupBy(*by).agg(
        F.sum("rows").alias("rows"), F.sum(F.col("gain") * _halvings(F.col("_newer"))).alias("gain")
    )


def running(mes: DataFrame, start: float = DEFAULT) -> DataFrame:
    """The value after folding all rows of a pair in time order: a becomes (a + rate) / 2, from ``start``."""
    value = F.lit(start) * _halvings(F.col("rows")) + F.col("gain")
    return folded(mes).select(*PAIR, value.alias("affinity"))


def lookup(rows: DataFrame, affinity: DataFrame) -> DataFrame:
    """Add ``affinity``; a pair never seen gets the default.

    Against many rows pass a written table, so that the planner knows how small it is.
    """
    joined = rows.join(affinity.select(*PAIR, F.col("affinity").alias("_known")), PAIR, "left")
    return joined.select(*rows.columns, F.coalesce("_known", F.lit(DEFAULT)).alias("affinity"))


def operators_of(mes: DataFrame) -> DataFrame:
    """The operators each machine has seen, one row each."""
    return mes.where("operator_id is not null").groupBy("machine_id", "operator_id").agg(
        F.min("ts").alias("first_seen"), F.count(F.lit(1)).alias("records")
    )


def ranked(affinity: DataFrame, top: int | None = None) -> DataFrame:
    """Operators of each machine by affinity, ties by operator id."""
    best = Window.partitionBy("machine_id").orderBy(F.col("affinity").desc(), F.col("operator_id").asc())
    out = affinity.withColumn("rank", F.row_number().over(best))
    if top is not None:
        out = out.where(F.col("rank") <= top)
    recommended = F.col("affinity") >= RECOMMENDED_FROM
    return out.select("machine_id", "operator_id", "affinity", "rank", recommended.alias("recommended"))
