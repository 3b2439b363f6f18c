"""Long metrics: one row per measurement, machine, field and time."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Measurement of each feed and the columns that are tags, not values.
MEASUREMENT = {"iot": "iot_metrics", "scada": "scada_metrics", "mes": "mes_metrics"}
BUCKET = {"iot_metrics": "iot-data", "scada_metrics": "scada-data", "mes_metrics": "mes-data"}
VALUES = {
    "iot": ["temperature_c", "vibration_mm_s", "pressure_bar"],
    "scada": ["power_kw"],
    "mes": ["operator_id", "units_produced", "defective_units", "production_time_min"],
}
TAGS = ["machine_status", "alarm_code"]


def to_long(feeds: Mapping[str, DataFrame], measurement: Mapping[str, str] = MEASUREMENT) -> DataFrame:
    """Route wide rows to (measurement, machine, tags, field, value, ts); null values make no row."""
    out = None
    for feed, rows in feeds.items():
        tags = [F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in TAGS]
        wide = rows.select(
            F.lit(measurement[feed]).alias("measurement"), "machine_id", "ts", "event_id", *tags,
            *[F.col(c).cast("double") for c in VALUES[feed]],
        )
        long = wide.unpivot(["measurement", "machine_id", "ts", "event_id", *TAGS], VALUES[feed], "field", "value")
        out = long if out is None else out.unionByName(long)
    return out.where("value is not null")


def write_long(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("overwrite").partitionBy("measurement").parquet(path)


def in_range(metrics: DataFrame, measurement: str, field: str, since: str) -> DataFrame:
    """Rows of one field from a time on; the measurement is a partition, so other folders are skipped."""
    since_ts = F.lit(since).cast(metrics.schema["ts"].dataType)
    return metrics.where((F.col("measurement") == measurement) & (F.col("field") == field) & (F.col("ts") >= since_ts))
