"""The last records of each machine on a stream, held in Spark's keyed state and read from it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

from millrace.operators import state
from millrace.operators.scan import micros
from millrace.streaming.load import TOPIC_SCHEMA

ENTRY = T.StructType([T.StructField("micros", T.LongType()), T.StructField("event_id", T.LongType()), T.StructField("record", T.StringType())])
HELD = T.StructType([T.StructField("machine_id", T.StringType()), T.StructField("slot", T.IntegerType()), T.StructField("held", T.IntegerType())])
RECORD = T.StructType([f for f in TOPIC_SCHEMA.fields if f.name not in ("ts", "machine_id", "event_id")])
NAMES = [f.name for f in ENTRY.fields]


class LastRecords(StatefulProcessor):
    """Keeps the newest ``records`` entries of a key; memory holds those and one Arrow batch."""

    def __init__(self, records: int, silent: dt.timedelta | None):
        self.records = records
        self.ttl = None if silent is None else int(silent.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.entries = handle.getListState("entries", ENTRY, self.ttl) if self.ttl else handle.getListState("entries", ENTRY)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        kept = [tuple(e) for e in self.entries.get()]
        for part in rows:
            kept += zip(part["micros"].tolist(), part["event_id"].tolist(), part["record"].tolist())
            kept = sorted(kept, key=lambda e: (e[0], e[1]))[-self.records:]
        self.entries.put([(int(m), int(e), r) for m, e, r in kept])
        yield pd.DataFrame({"machine_id": [key[0]], "slot": [key[1]], "held": [len(kept)]})

    def close(self) -> None:
        pass


def keep_history(
    topics: DataFrame, records: int = 48, slots: int = 8, silent: dt.timedelta | None = None
) -> DataStreamWriter:
    """Hold the last ``records`` rows of each machine over all topics, by event time and then id.

    A machine's rows are dealt to ``slots`` keys by their id and each holds its own last rows, which together
    hold those of the machine, so a machine with a third of all rows is not one task. The state is all that is kept,
    at most ``records`` times ``slots`` rows a machine, however long the stream runs; Spark drops old versions of it.
    ``silent`` lets a key go when it has had no row for so long (clock time); such a stream plans a batch at every trigger,
    so a run that is to end (``runs.resume``) needs ``spark.sql.streaming.noDataMicroBatches.enabled`` off. Rows without
    time, machine or id are left out.
    """
    fields = [f.name for f in RECORD.fields]
    keyed = topics.where("ts IS NOT NULL AND machine_id IS NOT NULL AND event_id IS NOT NULL").select(
        "machine_id", F.pmod(F.hash("event_id"), F.lit(slots)).alias("slot"), micros("ts").alias("micros"), "event_id",
        F.to_json(F.struct(*fields)).alias("record"),
    )
    held = keyed.groupBy("machine_id", "slot").transformWithStateInPandas(
        statefulProcessor=LastRecords(records, silent), outputStructType=HELD, outputMode="Update", timeMode="ProcessingTime" if silent else "None",
    )
    return held.writeStream.outputMode("update").format("noop")


def read_history(spark: SparkSession, folder: str, records: int = 48) -> DataFrame:
    """The history that a stream resumed in ``folder`` holds: its rows with ``age``, 1 for the newest of a machine."""
    rows = spark.read.format("statestore").option("stateVarName", "entries").load(f"{folder.rstrip('/')}/checkpoint")
    entry = "list_element"
    if "ttlExpirationMs" in rows.schema[entry].dataType.names:
        rows = rows.where(F.col(f"{entry}.ttlExpirationMs") > F.unix_millis(F.current_timestamp()))
        entry = f"{entry}.value"
    fields = F.from_json(f"{entry}.record", RECORD)
    found = rows.select(
        F.col("key.machine_id").alias("machine_id"), F.timestamp_micros(f"{entry}.micros").alias("ts"),
        F.col(f"{entry}.event_id").alias("event_id"), fields.alias("r"),
    ).select("machine_id", "ts", "event_id", "r.*")
    return state.last_n(found, records)
