"""Latest values and recent records per machine, by event time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import kpis
from millrace.operators.scan import Fill, fill, time_slice

STATE_COLUMNS = schemas.IOT_COLUMNS + schemas.SCADA_COLUMNS + schemas.MES_COLUMNS


def latest_of(column: str, order: Sequence[str] = ("ts", "event_id")) -> Column:
    """The last non-null value of a column in event order."""
    return F.max_by(column, F.when(F.col(column).isNotNull(), F.struct(*order))).alias(column)


def latest_state(
    rows: DataFrame, columns: Sequence[str] = tuple(STATE_COLUMNS), extra: Sequence[Column] = ()
) -> DataFrame:
    """One row per machine: the last known value of each field over all topics."""
    return rows.groupBy("machine_id").agg(F.max("ts").alias("ts"), *[latest_of(c) for c in columns], *extra)


def last_n(rows: DataFrame, n: int) -> DataFrame:
    """The last ``n`` rows of each machine; each map task forwards at most ``n`` rows per machine."""
    newest = Window.partitionBy("machine_id").orderBy(F.col("ts").desc(), F.col("event_id").desc())
    return rows.withColumn("age", F.row_number().over(newest)).where(F.col("age") <= n)


def latest_metric(metrics: DataFrame) -> DataFrame:
    """The last value of each machine and field of a long metrics table."""
    return metrics.groupBy("measurement", "machine_id", "field").agg(
        F.max_by("value", F.struct("ts", "event_id")).alias("value"), F.max("ts").alias("ts")
    )


def energy_per_unit_asof(rows: DataFrame, slice_s: int = 3600) -> DataFrame:
    """Each power reading divided by the units last reported before it (null: none yet, or zero)."""
    filled = fill(
        rows.select("machine_id", "ts", "event_id", "power_kw", "units_produced"),
        ["machine_id"], ["ts", "event_id"], time_slice("ts", slice_s), [Fill("units_asof", "units_produced")],
    )
    readings = filled.where("power_kw is not null")
    per_unit = kpis.ratio("power_kw", "units_asof").alias("energy_per_unit")
    return readings.select("machine_id", "ts", "event_id", "power_kw", "units_asof", per_unit)


def recent_power(rows: DataFrame, records: int = 48, readings: int = 24) -> DataFrame:
    """Power readings among each machine's last ``records`` rows, as arrays in time order.

    ``all_readings`` holds at most ``records`` entries and ``window`` its last ``readings``.
    """
    recent = last_n(rows, records).where("power_kw is not null")
    entry = F.struct("ts", "event_id", "power_kw")
    arrays = recent.groupBy("machine_id").agg(F.array_sort(F.collect_list(entry)).alias("all_readings"))
    size = F.size("all_readings")
    tail = F.when(size >= readings, F.slice("all_readings", F.lit(-readings), F.lit(readings))).otherwise(F.col("all_readings"))
    return arrays.withColumn("window", tail)
