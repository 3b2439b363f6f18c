"""Exact-key alignment of the three feeds and the features derived from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import kpis
from millrace.operators.scan import Fill, fill, time_slice
from millrace.session import written

KEY = ["ts", "machine_id"]


def _payload(rows: DataFrame, feed: str) -> DataFrame:
    return rows.select(*KEY, *schemas.FEED_COLUMNS[feed])


def outer(scada: DataFrame, iot: DataFrame, mes: DataFrame | None = None) -> DataFrame:
    out = _payload(scada, "scada").join(_payload(iot, "iot"), KEY, "full")
    return out if mes is None else out.join(_payload(mes, "mes"), KEY, "full")


def left_of_mes(mes: DataFrame, scada: DataFrame, iot: DataFrame) -> DataFrame:
    return _payload(mes, "mes").join(_payload(scada, "scada"), KEY, "left").join(_payload(iot, "iot"), KEY, "left")


def inner(scada: DataFrame, iot: DataFrame) -> DataFrame:
    return _payload(scada, "scada").join(_payload(iot, "iot"), KEY, "inner")


def forward_fill(rows: DataFrame, columns: Sequence[str] | None = None, slice_s: int = 86_400) -> DataFrame:
    """Carry the last known value of each column forward within a machine."""
    columns = [c for c in rows.columns if c not in KEY] if columns is None else list(columns)
    filled = fill(rows, ["machine_id"], ["ts"], time_slice("ts", slice_s), [Fill(c, c) for c in columns])
    return filled.select(*rows.columns)


POWER_FEATURES = [
    "machine_code", "temperature_c", "vibration_mm_s", "pressure_bar", "status_code", "alarm_code_no", "throughput",
    "defect_rate",
]
UNITS_FEATURES = [
    "machine_code", "temperature_c", "vibration_mm_s", "pressure_bar", "power_kw", "status_code", "alarm_code_no",
    "defect_rate", "throughput", "energy_efficiency",
]
STATE_FEATURES = ["machine_code", "power_kw", "temperature_c", "vibration_mm_s", "pressure_bar"]


def with_ratios(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "throughput": kpis.throughput(),
        "defect_rate": kpis.defect_rate(),
        "energy_efficiency": kpis.energy_efficiency(),
    })


CODE_NAMES = {"machine_id": "machine_code", "machine_status": "status_code", "alarm_code": "alarm_code_no"}


def codes(scada: DataFrame, *others: DataFrame) -> DataFrame:
    """(``column``, ``value``, ``code``): the rank of each value in text order, from 0.

    Machines are taken over all feeds, states and alarms from ``scada``, before the feeds are
    joined. The table is written first: the planner then knows its size and broadcasts it if it is
    small, instead of shuffling all rows by a column of few values.
    """
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in CODE_NAMES]
    found = scada.select(F.inline(F.array(*entries)))
    for rows in others:
        found = found.union(rows.select(F.lit("machine_id"), "machine_id"))
    return _ranked(found)


def dimension_codes(machines: DataFrame, machine_status: DataFrame, alarm_codes: DataFrame) -> DataFrame:
    """The same table from the dimensions, for streams: a code does not depend on what has arrived."""
    named = zip(CODE_NAMES, ((machines, "machine_name"), (machine_status, "status_name"), (alarm_codes, "alarm_name")))
    parts = [rows.select(F.lit(column).alias("column"), F.col(name).alias("value")) for column, (rows, name) in named]
    return _ranked(parts[0].union(parts[1]).union(parts[2]))


def _ranked(found: DataFrame) -> DataFrame:
    values = found.where("value is not null").distinct()
    rank = F.row_number().over(Window.partitionBy("column").orderBy("value")) - 1
    return written(values.withColumn("code", rank.cast("double")), "codes")


def coded(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Add the codes of machine, state and alarm; an unknown value gets null."""
    for column, name in CODE_NAMES.items():
        named = table.where(F.col("column") == column).select(F.col("value").alias(column), F.col("code").alias(name))
        rows = rows.join(named, column, "left").select(*rows.columns, name)
    return rows


def features(scada: DataFrame, iot: DataFrame, mes: DataFrame, table: DataFrame | None = None) -> DataFrame:
    """Aligned, filled and coded rows with the derived ratios; incomplete rows stay (see ``complete``).

    ``table`` holds the codes of the raw feeds; without it they come from the given rows.
    """
    return with_ratios(coded(forward_fill(outer(scada, iot, mes)), codes(scada, iot, mes) if table is None else table))


def complete(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return rows.na.drop(subset=list(columns))


def kpi_rows(mes: DataFrame, scada: DataFrame, iot: DataFrame) -> DataFrame:
    """Production rows with their power and sensor values and the ratios the cluster models use."""
    return left_of_mes(mes, scada, iot).withColumns({
        "time_per_unit": kpis.time_per_unit(),
        "defect_rate": kpis.defect_rate(),
        "defect_pct": kpis.defect_pct(),
        "energy_per_unit": kpis.energy_per_unit(),
    })


def rounded(rows: DataFrame, digits: int = 6) -> DataFrame:
    """All doubles to a number of digits, halves of the scaled value upwards."""
    scale = F.lit(float(10**digits))

    def one(c: str, kind: str) -> Column:
        return (F.round(F.col(c) * scale) / scale).alias(c) if kind == "double" else F.col(c)

    return rows.select(*[one(c, kind) for c, kind in rows.dtypes])
