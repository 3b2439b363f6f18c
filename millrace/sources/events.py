"""The three feeds as views of the generic ``events`` table (integer arithmetic on its ids)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import fresh_path

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENT_SCHEMA).parquet(f"{folder}/events.parquet")


def stream_events(spark: SparkSession, folder: str, glob: str = "events.parquet", files_per_batch: int | None = None) -> DataFrame:
    """The same table as a file stream; ``ts`` becomes TIMESTAMP, which watermarks need."""
    reader = spark.readStream.schema(EVENT_SCHEMA).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def closing_marker(spark: SparkSession) -> DataFrame:
    """A stream of one event of each kind far in the future, with negative ids.

    Joined to a finished input it moves the watermark past the last event, so that a replay
    also emits the newest rows. Drop negative ids from the result.
    """
    path = fresh_path(spark, "marker")
    kinds = F.array(*[F.lit(k) for k in ("click", "error", "purchase")])
    rows = spark.range(1).select(F.posexplode(kinds).alias("i", "event_type")).select(
        (-1 - F.col("i")).cast("long").alias("event_id"), F.lit("2100-01-01 00:00:00").cast("timestamp_ntz").alias("ts"),
        F.lit(0).cast("long").alias("user_id"), "event_type", F.lit(0.0).alias("value"), F.lit('{"k": 99}').alias("props"),
    )
    rows.write.parquet(path)
    return stream_events(spark, path, "*.parquet")


def _machine() -> Column:
    return F.concat(F.lit("Machine_"), (F.col("user_id") % 10 + 1).cast("string")).alias("machine_id")


def _steps(base: float, factor: int, modulus: int) -> Column:
    """base + ((event_id * factor) mod modulus) / 100, all operands double."""
    step = ((F.col("event_id") * F.lit(factor).cast("long")) % modulus).cast("double")
    return F.lit(float(base)) + step / F.lit(100.0)


def iot(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type").isin("click", "view")).select(
        "event_id",
        "ts",
        _machine(),
        _steps(60, 7919, 2001).alias("temperature_c"),
        _steps(0.4, 104729, 231).alias("vibration_mm_s"),
        _steps(3, 1299709, 451).alias("pressure_bar"),
    )


def scada(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    faults = F.array(F.lit("Low Pressure"), F.lit("Overheat"), F.lit("Vibration High"))
    status = F.when(F.col("k") < 6, "Error").when(F.col("k") < 16, "Idle").otherwise("Running")
    alarm = (
        F.when(F.col("k") < 6, F.element_at(faults, (F.col("event_id") % 3 + 1).cast("int")))
        .when(F.col("k") < 16, "")
        .when(F.col("k") >= 94, "Low Pressure")
        .when(F.col("k") >= 91, "Overheat")
        .when(F.col("k") >= 89, "Vibration High")
        .when(F.col("k") == 50, F.lit(None).cast("string"))
        .otherwise("None")
    )
    power = F.lit(100.0) + F.col("k").cast("double") + (F.col("event_id") % 100).cast("double") / F.lit(100.0)
    rows = events.where(F.col("event_type").isin("error", "signup")).withColumn("k", k)
    return rows.select(
        "event_id", "ts", _machine(), power.alias("power_kw"), status.alias("machine_status"), alarm.alias("alarm_code")
    )


def mes(events: DataFrame) -> DataFrame:
    event = F.col("event_id")
    units = F.when(event % 97 == 0, 0).otherwise((event % 451 + 50).cast("int"))
    return events.where("event_type = 'purchase'").select(
        "event_id",
        "ts",
        _machine(),
        (F.floor(F.col("user_id") / 10) % 10 + 1000).cast("int").alias("operator_id"),
        units.alias("units_produced"),
        (event % 10).cast("int").alias("defective_units"),
        (event % 111 + 10).cast("double").alias("production_time_min"),
    )


FEEDS = {"iot": iot, "scada": scada, "mes": mes}


def feed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return FEEDS[name](read_events(spark, folder))


def hourly(rows: DataFrame) -> DataFrame:
    """The last row of each machine and hour, stamped with the hour."""
    hour = F.date_trunc("hour", "ts").cast(rows.schema["ts"].dataType)
    payload = [c for c in rows.columns if c not in ("ts", "machine_id")]
    last = rows.groupBy("machine_id", hour.alias("hour")).agg(F.max_by(F.struct(*payload), F.struct("ts", "event_id")).alias("_last"))
    return last.select(*[F.col(f"_last.{c}").alias(c) if c in payload else F.col("hour" if c == "ts" else c).alias(c) for c in rows.columns])


def by_topic(feeds: dict[str, DataFrame]) -> DataFrame:
    """All feeds as one table with a ``topic`` column; columns a feed lacks are null."""
    out = None
    for topic, rows in feeds.items():
        tagged = rows.withColumn("topic", F.lit(topic))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out
