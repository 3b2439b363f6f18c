"""Aggregates of the fact table per machine or plant and day, ISO week or month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import clean
from millrace.functions.kpis import ratio

GRAINS = ("day", "week", "month")


def units(fact: DataFrame, grain: str) -> DataFrame:
    keyed = fact.groupBy("machine_id", clean.period("ts", grain).alias("period"))
    return keyed.agg(F.sum(F.col("units_produced").cast("long")).alias("units_produced"))


def failures(fact: DataFrame, grain: str) -> DataFrame:
    keyed = fact.where(clean.is_failure()).groupBy("machine_id", clean.period("ts", grain).alias("period"))
    return keyed.agg(F.count(F.lit(1)).alias("failure_count"))


def efficiency(fact: DataFrame, grain: str) -> DataFrame:
    """Share of good units in percent, from sums; null when nothing was produced."""
    good = F.sum(F.col("units_produced") - F.col("defective_units"))
    percent = F.round(ratio(good, F.sum("units_produced")) * F.lit(100.0), 2)
    keyed = fact.groupBy("machine_id", clean.period("ts", grain).alias("period"))
    return keyed.agg(percent.alias("efficiency_pct"))


def power(fact: DataFrame, grain: str) -> DataFrame:
    keyed = fact.groupBy("machine_id", clean.period("ts", grain).alias("period"))
    return keyed.agg(F.sum("power_kw").alias("power_kw"))


def plant_power(fact: DataFrame, grain: str) -> DataFrame:
    return fact.groupBy(clean.period("ts", grain).alias("period")).agg(F.sum("power_kw").alias("power_kw"))


MARTS = {"units": units, "failures": failures, "efficiency": efficiency, "power": power, "plant_power": plant_power}
VALUE_OF = {
    "units": "units_produced",
    "failures": "failure_count",
    "efficiency": "efficiency_pct",
    "power": "power_kw",
    "plant_power": "power_kw",
}


def daily_sums(fact: DataFrame) -> DataFrame:
    """Everything the marts need per machine and day, in one pass over the fact table."""
    day = F.col("day") if "day" in fact.columns else F.to_date("ts")
    failed = F.coalesce(clean.is_failure(), F.lit(False))
    return fact.groupBy("machine_id", day.alias("day")).agg(
        F.sum(F.col("units_produced").cast("long")).alias("units"),
        F.sum((F.col("units_produced") - F.col("defective_units")).cast("long")).alias("good"),
        F.count(F.when(failed, 1)).alias("failures"),
        F.sum("power_kw").alias("power"),
    )


def from_daily(sums: DataFrame, report: str, grain: str) -> DataFrame:
    """The mart ``report`` of ``grain`` from ``daily_sums``."""
    keys = [clean.period("day", grain).alias("period")]
    if report != "plant_power":
        keys.insert(0, F.col("machine_id"))
    grouped = sums.groupBy(*keys)
    if report == "units":
        return grouped.agg(F.sum("units").alias("units_produced"))
    if report == "failures":
        return grouped.agg(F.sum("failures").alias("failure_count")).where("failure_count > 0")
    if report == "efficiency":
        percent = F.round(ratio(F.sum("good"), F.sum("units")) * F.lit(100.0), 2)
        return grouped.agg(percent.alias("efficiency_pct"))
    if report in ("power", "plant_power"):
        return grouped.agg(F.sum("power").alias("power_kw"))
    raise ValueError(f"unknown report {report!r}")
