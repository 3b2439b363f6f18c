"""Tables kept by key in files partitioned by day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.fact import only_new
from millrace.session import written

KEY = ("ts", "machine_id")


def exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def child_folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Values of the partition folders ``<prefix>=<value>`` directly below ``path``."""
    if not exists(spark, path):
        return []
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{prefix}="))


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file; false if there is one already. Of several callers one succeeds."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = file.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(file.getParent())
    return not system.exists(file) and system.createNewFile(file)


def remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def rejects_path(path: str) -> str:
    """Where rows without a whole key are kept that were sent to the table at ``path``."""
    return f"{path.rstrip('/')}_rejects"


def keyed(rows: DataFrame, path: str, key: Sequence[str] = KEY) -> DataFrame:
    """The rows that have every key column; the others go to ``rejects_path(path)``, equal ones once.

    Rejecting the same rows again adds nothing. ``rows`` should come from files: they are read twice.
    """
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
    bad = rows.where(~whole)
    if not bad.isEmpty():
        folder = rejects_path(path)
        bad = bad.withColumn("reject_id", F.xxhash64(*rows.columns)).dropDuplicates(["reject_id"])
        if exists(rows.sparkSession, folder):
            bad = bad.join(rows.sparkSession.read.parquet(folder).select("reject_id"), "reject_id", "left_anti")
        written(bad, "rejects").write.mode("append").parquet(folder)
    return rows.where(whole)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table's rows, or none when it was never written."""
    full = T.StructType([*[f for f in schema.fields if f.name != "day"], T.StructField("day", T.DateType())])
    if not exists(spark, path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(path)


def last_per_key(rows: DataFrame, key: Sequence[str], version: Sequence[str]) -> DataFrame:
    """The row of greatest version per key, with map-side partial results."""
    rest = [c for c in rows.columns if c not in key]
    newest = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*version)).alias("_row"))
    return newest.select(*[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in rows.columns])


def days_of(rows: DataFrame) -> list[dt.date]:
    """The days of ``rows``, as many as their calendar span has."""
    return sorted(r["day"] for r in rows.select("day").distinct().collect())


def _of_days(table: DataFrame, rows: DataFrame) -> DataFrame:
    """The partitions of ``table`` for the days in ``rows``, named as literals so that the scan skips
    the others; the list is as long as the calendar span of ``rows``."""
    return table.where(F.col("day").isin(days_of(rows)))


def _replace_days(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def upsert(rows: DataFrame, path: str, key: Sequence[str] = KEY, version: Sequence[str] = ("event_id",)) -> list[dt.date]:
    """Last write wins per key: rewrite only the days that ``rows`` touch, and return them.

    Running the same batch twice leaves the same table. Rows without a whole key are rejected. The merged days are written to the shared
    folder before they replace the old ones.
    """
    spark = rows.sparkSession
    arriving = keyed(written(rows.withColumn("day", F.to_date("ts")), "arriving"), path, key)
    present = _of_days(read_table(spark, path, rows.schema), arriving).select(*arriving.columns)
    merged = last_per_key(present.unionByName(arriving), [*key, "day"], version)
    merged = written(merged, "merged")
    _replace_days(merged, path)
    return days_of(merged)


def insert_new(rows: DataFrame, path: str, key: Sequence[str] = KEY, version: Sequence[str] = ("event_id",)) -> list[dt.date]:
    """First write wins per key: append rows whose key the table lacks; running twice adds nothing.

    Returns the days that ``rows`` touch, whether or not their keys were new: after a failure between
    append and bookkeeping the repeated load names them again.
    Rows without a whole key are rejected.
    """
    spark = rows.sparkSession
    arriving = keyed(written(rows.withColumn("day", F.to_date("ts")), "arriving"), path, key)
    rest = [c for c in arriving.columns if c not in (*key, "day")]
    first = arriving.groupBy(*key, "day").agg(F.min_by(F.struct(*rest), F.struct(*version)).alias("_row"))
    first = first.select(*[F.col(f"_row.{c}").alias(c) if c in rest else F.col(c) for c in arriving.columns])
    present = _of_days(read_table(spark, path, rows.schema), arriving)
    fresh = written(only_new(first, present, (*key, "day")), "fresh")
    fresh.write.mode("append").partitionBy("day").parquet(path)
    return days_of(arriving)


def refresh_days(fact: DataFrame, changed_days: DataFrame, aggregate, path: str) -> None:
    """Recompute a daily aggregate for the changed days only and replace those partitions."""
    dated = fact if "day" in fact.columns else fact.withColumn("day", F.to_date("ts"))
    touched = _of_days(dated, changed_days)
    _replace_days(aggregate(touched.drop("day")).withColumnRenamed("period", "day"), path)
