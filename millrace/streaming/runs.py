"""Start streaming queries and keep versioned snapshots of small state tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from millrace.operators.upsert import child_folders, exists
from millrace.session import fresh_path

BatchFunction = Callable[[DataFrame, int], None]


def replay(writer: DataStreamWriter, spark: SparkSession, name: str) -> None:
    """Process all input there is, then stop."""
    writer.option("checkpointLocation", fresh_path(spark, f"{name}-checkpoint")).trigger(availableNow=True).start().awaitTermination()


def resume(writer: DataStreamWriter, folder: str) -> None:
    """Process what has arrived since the last call, then stop; progress is kept beside the state in ``folder``."""
    writer.option("checkpointLocation", f"{folder.rstrip('/')}/checkpoint").trigger(availableNow=True).start().awaitTermination()


def follow(writer: DataStreamWriter, checkpoint: str, every: str = "1 minute"):
    """Run until stopped, one batch per interval."""
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=every).start()


def to_table(rows: DataFrame, path: str) -> DataStreamWriter:
    return rows.writeStream.format("parquet").outputMode("append").option("path", path)


def per_batch(rows: DataFrame, function: BatchFunction, mode: str = "append") -> DataStreamWriter:
    return rows.writeStream.outputMode(mode).foreachBatch(function)


class Snapshots:
    """A table kept as one full version per batch: batch n reads an earlier version and writes version n.

    A repeated batch reads and writes the same versions, so it changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _versions(self) -> list[int]:
        found = [int(v) for v in child_folders(self.spark, self.path, "version")]
        return sorted(v for v in found if exists(self.spark, f"{self.path}/version={v}/_SUCCESS"))

    def before(self, batch: int) -> DataFrame:
        """The newest version below ``batch``; no rows if there is none."""
        older = [v for v in self._versions() if v < batch]
        if not older:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/version={older[-1]}")

    def write(self, rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/version={batch}")

    def latest(self) -> DataFrame:
        return self.before(1 << 62)


class BatchFolders:
    """Rows kept by day and batch; a repeated batch replaces its own folders."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path = spark, path.rstrip("/")
        self.schema = T.StructType([*schema.fields, T.StructField("day", T.DateType()), T.StructField("batch", T.LongType())])

    def write(self, rows: DataFrame, batch: int, ts: str = "ts") -> None:
        dated = rows.withColumn("day", F.to_date(ts)).withColumn("batch", F.lit(batch).cast("long"))
        writer = dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("day", "batch").parquet(self.path)

    def read(self, since: str | None = None) -> DataFrame:
        """All rows, or those from a day on; only the folders of those days are listed."""
        days = child_folders(self.spark, self.path, "day")
        paths = [f"{self.path}/day={d}" for d in days if since is None or d >= since]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*paths)
