"""Power anomalies per machine from its last readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.clean import clip
from millrace.operators.state import recent_power

RECORDS, READINGS = 48, 24
LEAST, ROBUST_BELOW, REQUIRED = 5, 10, 10
THRESHOLD = 0.8
# Both factors apply, one after the other.
MAD_FACTOR, ROBUST_FACTOR = 1.4826, 0.6745


def array_median(values: Column) -> Column:
    ordered, n = F.array_sort(values), F.size(values)
    low, high = F.floor((n - 1) / 2).cast("int"), F.floor(n / 2).cast("int")
    return (F.get(ordered, low) + F.get(ordered, high)) / 2


def array_mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v) / F.size(values)


def window_stats(rows: DataFrame) -> DataFrame:
    """Per machine: statistics of the window of its last readings (at most 24 of the last 48 records)."""
    out = recent_power(rows, RECORDS, READINGS)
    out = out.withColumn("values", F.transform("window", lambda r: r["power_kw"]))
    values = F.col("values")
    out = out.withColumns({
        "available_readings": F.size("all_readings"),
        "n": F.size(values),
        "mean_kw": array_mean(values),
        "median_kw": array_median(values),
        "min_kw": F.array_min(values),
        "max_kw": F.array_max(values),
        "current_kw": F.element_at(values, -1),
        "window_start": F.element_at("all_readings", 1)["ts"],
        "window_end": F.element_at("all_readings", -1)["ts"],
    })
    squares = F.transform(values, lambda v: (v - F.col("mean_kw")) * (v - F.col("mean_kw")))
    gaps = F.transform(values, lambda v: F.abs(v - F.col("median_kw")))
    return out.withColumns({"std_kw": F.sqrt(array_mean(squares)), "mad_kw": F.lit(MAD_FACTOR) * array_median(gaps)})


def insufficient(rows: DataFrame) -> DataFrame:
    """Machines with too few readings for any statement, and their last three time stamps."""
    machines = rows.select("machine_id").distinct()
    found = recent_power(rows, RECORDS, READINGS)
    out = machines.join(found, "machine_id", "left")
    readings = F.coalesce(F.size("all_readings"), F.lit(0))
    readings = F.when(F.col("all_readings").isNull(), 0).otherwise(readings)
    stamps = F.transform("all_readings", lambda r: F.date_format(r["ts"], "yyyy-MM-dd HH:mm:ss"))
    last = F.when(F.size(stamps) <= 3, stamps).otherwise(F.slice(stamps, -3, 3))
    out = out.withColumn("available_readings", readings).where(F.col("available_readings") < LEAST)
    return out.select(
        "machine_id", F.lit("insufficient_data").alias("status"), "available_readings",
        F.lit(REQUIRED).alias("required_readings"), F.array_join(last, ",").alias("last_data_points"),
    )


def _kw(value: Column) -> Column:
    return F.round(value, 1).cast("string")


def detect(rows: DataFrame) -> DataFrame:
    """Score of each machine's current reading against its window; needs five readings or more.

    Below ten readings the distance is in median absolute deviations, else in standard deviations;
    a window without spread gives distance 0.
    """
    stats = window_stats(rows).where(F.col("available_readings") >= LEAST)
    robust = F.col("n") < ROBUST_BELOW
    by_mad = F.when(F.col("mad_kw") > 0, ROBUST_FACTOR * (F.col("current_kw") - F.col("median_kw")) / F.col("mad_kw")).otherwise(0.0)
    by_std = F.when(F.col("std_kw") > 0, (F.col("current_kw") - F.col("mean_kw")) / F.col("std_kw")).otherwise(0.0)
    score = clip(0.5 + F.abs(F.when(robust, by_mad).otherwise(by_std)) / 3, 0.0, 1.0)
    scored = stats.withColumn("score", score).withColumn("is_anomaly", F.col("score") > THRESHOLD)
    hours = (F.unix_micros(F.col("window_end").cast("timestamp")) - F.unix_micros(F.col("window_start").cast("timestamp"))) / F.lit(3.6e9)
    expected = F.concat(
        F.lit("Power consumption "), _kw(F.col("current_kw")), F.lit("kW vs expected range ["),
        _kw(F.col("mean_kw") - 2 * F.col("std_kw")), F.lit("-"), _kw(F.col("mean_kw") + 2 * F.col("std_kw")), F.lit("]kW"),
    )
    return scored.select(
        "machine_id", "current_kw", "window_start", "window_end", hours.alias("hours_covered"), "mean_kw", "median_kw",
        "std_kw", "min_kw", "max_kw", F.col("n").alias("data_points"), "score", "is_anomaly",
        F.when(robust, "MAD").otherwise("Z-score").alias("method"),
        clip(F.col("score") * 1.2, 0.5, 0.99).alias("confidence"),
        F.when(F.col("is_anomaly"), "high").otherwise("low").alias("priority"),
        F.when(F.col("is_anomaly"), "Immediate inspection recommended").otherwise("Routine monitoring sufficient").alias("action"),
        F.when(robust, "Limited historical data").otherwise(expected).alias("trigger"),
    )


def peak_ratio(rows: DataFrame, missing_as_zero: bool = False) -> DataFrame:
    """Greatest over mean power of each machine; 1 with a single record."""
    power = F.coalesce(F.col("power_kw"), F.lit(0.0)) if missing_as_zero else F.col("power_kw")
    sums = rows.groupBy("machine_id").agg(F.count(power).alias("records"), F.max(power).alias("_max"), F.avg(power).alias("_mean"))
    ratio = F.when(F.col("records") <= 1, 1.0).otherwise(F.try_divide("_max", "_mean"))
    return sums.select("machine_id", "records", ratio.alias("peak_ratio"))
