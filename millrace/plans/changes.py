"""A log of the days that loads have touched, read by what is derived from the table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession

from millrace.operators.upsert import child_folders, remove


class ChangeLog:
    """One small folder per load until its days have been refreshed.

    A load that is repeated writes the same folder. The folders are removed after the refresh, so a
    refresh that fails is done again, and the log holds only what is still to do.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def write(self, days: Sequence[dt.date], load: str) -> None:
        if days:
            self.spark.createDataFrame([(d,) for d in days], "day date").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/load={load}")

    def consume(self, refresh: Callable[[list[dt.date]], None]) -> list[dt.date]:
        """Calls ``refresh`` with the days of all loads in the log and then forgets these loads; returns the days."""
        loads = [f"{self.path}/load={x}" for x in child_folders(self.spark, self.path, "load")]
        if not loads:
            return []
        days = sorted(r["day"] for r in self.spark.read.schema("day date").parquet(*loads).distinct().collect())
        refresh(days)
        for load in loads:
            remove(self.spark, load)
        return days
