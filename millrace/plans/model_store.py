"""Versions of fitted models below one folder, with roll-back and expiry.

``<root>/<name>/version=<n>`` holds the rows of a model. A number is claimed first, by an empty file that
only one publisher can create, so publishers at the same time get different versions. The marker that
Spark leaves when all rows are written commits a version: a reader sees whole versions only, and a publisher
that dies leaves none. The current version is the highest one. History is never rewritten: a roll-back publishes
the older model again under a new number. On stores without an atomic create let one publisher work per name.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.linear import Classifier, LinearModel
from millrace.operators.upsert import child_folders, claim, exists, remove
from millrace.plans import forecasts

STORED = f"{forecasts.ROWS}, published_at timestamp, restored_from int"


class ModelStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _folder(self, name: str) -> str:
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", name):
            raise ValueError(f"a model's name is letters, digits, '_', '.' and '-', not {name!r}")
        return f"{self.root}/{name}"

    def versions(self, name: str) -> list[int]:
        """Committed versions, oldest first."""
        folder = self._folder(name)
        found = sorted(int(v) for v in child_folders(self.spark, folder, "version"))
        return [v for v in found if exists(self.spark, f"{folder}/version={v}/_SUCCESS")]

    def current(self, name: str) -> int:
        found = self.versions(name)
        if not found:
            raise LookupError(f"no version of {name!r}")
        return found[-1]

    def publish(self, name: str, model: LinearModel | Classifier, restored_from: int | None = None) -> int:
        """A new version, current from its commit on; returns its number."""
        folder = self._folder(name)
        taken = [int(v) for prefix in ("claim", "version") for v in child_folders(self.spark, folder, prefix)]
        version = max(taken, default=0) + 1
        while not claim(self.spark, f"{folder}/claim={version}"):
            version += 1
        rows = self.spark.createDataFrame(forecasts.lines(model), forecasts.ROWS)
        stamped = rows.select("*", F.current_timestamp().alias("published_at"), F.lit(restored_from).cast("int").alias("restored_from"))
        stamped.coalesce(1).write.mode("overwrite").parquet(f"{folder}/version={version}")
        return version

    def _rows(self, name: str, versions: list[int]) -> DataFrame:
        folder = self._folder(name)
        if not versions:
            return self.spark.createDataFrame([], f"{STORED}, version int")
        paths = [f"{folder}/version={v}" for v in versions]
        return self.spark.read.schema(f"{STORED}, version int").option("basePath", folder).parquet(*paths)

    def load(self, name: str, version: int | None = None) -> LinearModel | Classifier:
        """The current model, or the one of a committed version."""
        found = self.versions(name)
        wanted = self.current(name) if version is None else version
        if wanted not in found:
            raise LookupError(f"no version {wanted} of {name!r}")
        return forecasts.from_lines(self._rows(name, [wanted]).orderBy("class", "position").collect())

    def history(self, name: str) -> DataFrame:
        """One row per committed version."""
        return self._rows(name, self.versions(name)).groupBy("version").agg(
            F.first("published_at").alias("published_at"), F.first("restored_from").alias("restored_from"), F.count(F.lit(1)).alias("rows")
        )

    def roll_back(self, name: str, version: int | None = None) -> int:
        """Publish an earlier version again: the one named, or the one before the current."""
        earlier = self.versions(name)[:-1]
        wanted = version if version is not None else (earlier[-1] if earlier else None)
        if wanted not in earlier:
            raise LookupError(f"no earlier version {wanted} of {name!r}")
        return self.publish(name, self.load(name, wanted), wanted)

    def expire(self, name: str, keep: int = 5) -> list[int]:
        """Remove all but the newest ``keep`` (at least one) versions, and what failed publishers left below them.

        Returns the versions that went. Numbers are not given out again: claims stay, as empty files, from the oldest kept on.
        """
        folder, found = self._folder(name), self.versions(name)
        if not found:
            return []
        oldest = found[-max(1, keep):][0]
        for prefix in ("version", "claim"):
            for v in child_folders(self.spark, folder, prefix):
                if int(v) < oldest:
                    remove(self.spark, f"{folder}/{prefix}={v}")
        return [v for v in found if v < oldest]
