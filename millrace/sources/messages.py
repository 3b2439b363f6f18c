"""JSON messages: the flat event per machine and the nested snapshot of all machines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.functions import clean
from millrace.operators.scan import running_sum
from millrace.sources.files import field_names, renamed, to_utc
from millrace.sources.offsets import record_id

BAD = "_bad"


def kafka_messages(
    spark: SparkSession, servers: str, topics: Sequence[str], starting: str = "earliest", per_trigger: int | None = None,
) -> DataFrame:
    """Messages of several topics as a stream; needs the Kafka connector on the class path.

    ``per_trigger`` bounds the records that one batch admits, also after a long stop.
    """
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics)).option("startingOffsets", starting)
    )
    rows = (reader.option("maxOffsetsPerTrigger", per_trigger) if per_trigger else reader).load()
    return rows.select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))


def message_files(spark: SparkSession, path: str, files_per_batch: int = 16) -> DataFrame:
    """The same messages from text files below ``path/topic=<name>/``."""
    schema = T.StructType([T.StructField("value", T.StringType()), T.StructField("topic", T.StringType())])
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).text(path)


RECORD = T.StructType([
    T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType()),
    T.StructField("value", T.StringType()),
])


def record_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The columns of ``kafka_messages`` from files of ``write_record_files``."""
    reader = spark.readStream.schema(RECORD)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)


def write_record_files(records: DataFrame, path: str) -> None:
    records.select(*[f.name for f in RECORD.fields]).write.mode("append").parquet(path)


def in_log(messages: DataFrame, partitions: Mapping[str, int], order: str, slice_: Column) -> DataFrame:
    """Adds ``partition`` (by key) and ``offset`` as a broker numbers them that receives the messages by ``order``.

    ``order`` must be unique; ``slice_`` cuts it, so that no task numbers a whole partition.
    """
    count = F.create_map(*[F.lit(x) for pair in partitions.items() for x in pair])[F.col("topic")]
    dealt = messages.withColumn("partition", F.pmod(F.crc32("key"), count).cast("int"))
    numbered = running_sum(dealt, ["topic", "partition"], [order], slice_, "_place")
    return numbered.withColumn("offset", F.col("_place") - 1).drop("_place")


def parse_topics(records: DataFrame, source_tz: str = "UTC") -> DataFrame:
    """All feeds from their messages in one pass: ``topic`` (the feed), ``event_id`` (see ``offsets.record_id``) and typed columns.

    Fields that a feed lacks are null. ``is_rejected`` marks text that does not parse, topics that
    no feed has, and records without offset.
    """
    fields = {f.name: f for schema in schemas.MESSAGES.values() for f in schema.fields}
    body = F.from_json("value", T.StructType([*fields.values(), T.StructField(BAD, T.StringType())]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD})
    feed = F.create_map(*[F.lit(x) for name, topic in schemas.TOPICS.items() for x in (topic, name)])[F.col("topic")]
    rows = records.select(feed.alias("topic"), record_id().alias("event_id"), body.alias("_m"))
    ts = to_utc(clean.parse_ts("_m.Timestamp"), source_tz)
    rejected = F.coalesce(F.col(f"_m.{BAD}").isNotNull(), F.lit(True)) | ts.isNull() | F.col("topic").isNull() | F.col("event_id").isNull()
    columns = [F.col(f"_m.{f}").alias(schemas.COLUMN_OF[f]) for f in fields if f not in ("Timestamp", "Alarm_Code")]
    return rows.select("topic", "event_id", ts.alias("ts"), *columns, clean.norm_alarm("_m.Alarm_Code").alias("alarm_code"), rejected.alias("is_rejected"))


def parse(messages: DataFrame, feed: str, source_tz: str = "UTC") -> DataFrame:
    """Typed columns of one feed from its messages; ``is_rejected`` marks text that does not parse.

    Unknown fields drop, the alarm is normalised, other message columns (topic, offset) stay.
    """
    schema = T.StructType([*schemas.MESSAGES[feed].fields, T.StructField(BAD, T.StringType())])
    body = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD})
    kept = [c for c in messages.columns if c != "value"]
    rows = messages.withColumn("_m", body)
    ts = to_utc(clean.parse_ts("_m.Timestamp"), source_tz)
    rejected = F.col(f"_m.{BAD}").isNotNull() | ts.isNull()
    fields = [F.col(f"_m.{f.name}") for f in schemas.MESSAGES[feed].fields]
    out = renamed(rows.select(*kept, *fields, rejected.alias("is_rejected"))).withColumn("ts", to_utc(clean.parse_ts("ts"), source_tz))
    return out.withColumn("alarm_code", clean.norm_alarm("alarm_code")) if feed == "scada" else out


def publishable(rows: DataFrame, feed: str, keep: Sequence[str] = ()) -> DataFrame:
    """(``topic``, ``key``, ``value``): one JSON object per row, keyed by machine; columns in ``keep`` stay beside it."""
    names = [f.name for f in schemas.MESSAGES[feed].fields]
    text = rows.select(*[schemas.COLUMN_OF[n] for n in names], *keep).withColumn("ts", clean.format_ts("ts"))
    if feed == "scada":
        text = text.withColumn("alarm_code", clean.denorm_alarm("alarm_code"))
    text = field_names(text)
    return text.select(F.lit(schemas.TOPICS[feed]).alias("topic"), F.col("Machine_ID").alias("key"), F.to_json(F.struct(*names)).alias("value"), *keep)


def write_kafka(messages: DataFrame, servers: str) -> None:
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def write_message_files(messages: DataFrame, path: str) -> None:
    messages.select("topic", "value").write.mode("append").partitionBy("topic").text(path)


# Key of the shared time stamp and fields of each machine in a snapshot.
SNAPSHOT_TIME = {"iot": "Timestamp_Sensor", "scada": "Timestamp_SCADA"}
MACHINE_PREFIX = "Machine_"


def flatten_snapshot(snapshots: DataFrame, feed: str, value: str = "value") -> DataFrame:
    """One row per machine of a nested snapshot; machines are the keys that start with ``Machine_``.

    A snapshot without a time stamp gets the current time; a missing alarm becomes ''.
    """
    fields = [f for f in schemas.MESSAGES[feed].fields if f.name not in ("Timestamp", "Machine_ID")]
    cell = T.StructType([
        T.StructField("Value", T.StringType()),
        *[T.StructField(f.name, T.StructType([T.StructField("Value", f.dataType)])) for f in fields],
    ])
    everything = F.from_json(value, T.MapType(T.StringType(), cell))
    machines = F.map_filter("_all", lambda key, _: key.startswith(MACHINE_PREFIX))
    taken = F.try_to_timestamp(F.col("_all")[SNAPSHOT_TIME[feed]]["Value"], F.lit(schemas.TS_FORMAT))
    rows = snapshots.withColumn("_all", everything)
    rows = rows.select(F.coalesce(taken, F.current_timestamp()).alias("ts"), F.explode(machines).alias("machine_id", "_m"))
    out = rows.select("ts", "machine_id", *[F.col(f"_m.{f.name}.Value").alias(schemas.COLUMN_OF[f.name]) for f in fields])
    return out.withColumn("alarm_code", F.coalesce("alarm_code", F.lit(""))) if feed == "scada" else out


def snapshots(rows: DataFrame, feed: str) -> DataFrame:
    """The inverse of ``flatten_snapshot``: one nested JSON text per instant (one entry per machine)."""
    fields = [schemas.COLUMN_OF[f.name] for f in schemas.MESSAGES[feed].fields if f.name not in ("Timestamp", "Machine_ID")]
    cells = F.to_json(F.struct(*[F.struct(F.col(c).alias("Value")).alias(schemas.FIELD_OF[c]) for c in fields]))
    entry = F.concat(F.lit('"'), F.col("machine_id"), F.lit('":'), cells)
    head = F.concat(F.lit('{"' + SNAPSHOT_TIME[feed] + '":{"Value":"'), clean.format_ts("ts"), F.lit('"},'))
    grouped = rows.groupBy("ts").agg(F.array_join(F.array_sort(F.collect_list(entry)), ",").alias("_cells"))
    return grouped.select(F.concat(head, F.col("_cells"), F.lit("}")).alias("value"))
