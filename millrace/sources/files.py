"""Feed files: CSV in, Parquet tables out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.functions import clean


def renamed(rows: DataFrame) -> DataFrame:
    """Message field names to the column names of this library."""
    return rows.withColumnsRenamed({f: c for f, c in schemas.COLUMN_OF.items() if f in rows.columns})


def field_names(rows: DataFrame) -> DataFrame:
    return rows.withColumnsRenamed({c: f for c, f in schemas.FIELD_OF.items() if c in rows.columns})


def read_feed_csv(spark: SparkSession, path: str, feed: str, null_text: str | None = None, source_tz: str = "UTC") -> DataFrame:
    """A feed file with a header. The text 'None' is kept unless ``null_text`` names it a null."""
    reader = spark.read.schema(schemas.MESSAGES[feed]).option("header", True).option("enforceSchema", False)
    # An empty text must stay distinct from a missing one.
    reader = reader.option("emptyValue", "").option("nullValue", null_text if null_text is not None else "\u0000")
    rows = renamed(reader.csv(path))
    return rows.withColumn("ts", to_utc(clean.parse_ts("ts"), source_tz))


def to_utc(ts, source_tz: str):
    return ts if source_tz == "UTC" else F.to_utc_timestamp(ts, source_tz)


def write_feed_csv(rows: DataFrame, path: str, feed: str) -> None:
    columns = [schemas.COLUMN_OF[f.name] for f in schemas.MESSAGES[feed].fields]
    text = rows.select(*columns).withColumn("ts", clean.format_ts("ts"))
    field_names(text).write.option("header", True).option("emptyValue", '""').option("nullValue", "\u0000").csv(path)


def write_by_day(rows: DataFrame, path: str, ts: str = "ts") -> None:
    """A table partitioned by day, so later reads prune by date."""
    rows.withColumn("day", F.to_date(ts)).write.mode("overwrite").partitionBy("day").parquet(path)


def read_by_day(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    with_day = T.StructType([*schema.fields, T.StructField("day", T.DateType())])
    return spark.read.schema(with_day).parquet(path)
