"""Ratios derived from production and power values; a zero divisor gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column | str, b: Column | str) -> Column:
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.try_divide(a.cast("double"), b.cast("double"))


def time_per_unit() -> Column:
    return ratio("production_time_min", "units_produced")


def defect_rate() -> Column:
    return ratio("defective_units", "units_produced")


def defect_pct() -> Column:
    return defect_rate() * F.lit(100.0)


def energy_per_unit() -> Column:
    return ratio("power_kw", "units_produced")


def throughput() -> Column:
    return ratio("units_produced", "production_time_min")


def energy_efficiency() -> Column:
    """kWh per unit."""
    return ratio(F.col("power_kw") * (F.col("production_time_min") / F.lit(60.0)), "units_produced")


def success_rate() -> Column:
    return F.lit(1.0) - defect_rate()
