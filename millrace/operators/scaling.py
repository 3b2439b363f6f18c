"""Standardisation by population mean and standard deviation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fit_table(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean and standard deviation per feature as rows; a zero deviation counts as 1."""
    sums = df.agg(*[F.avg(c).alias(f"m_{c}") for c in features], *[F.stddev_pop(c).alias(f"s_{c}") for c in features])
    entries = [
        F.struct(F.lit(c).alias("feature"), F.col(f"m_{c}").alias("mean"), _or_one(F.col(f"s_{c}")).alias("std"))
        for c in features
    ]
    return sums.select(F.inline(F.array(*entries)))


def _or_one(std: Column) -> Column:
    return F.when(std == 0, F.lit(1.0)).otherwise(std)


@dataclass(frozen=True)
class Scaler:
    """Fitted means and deviations; a model parameter, so it is held by the driver."""

    mean: dict[str, float]
    std: dict[str, float]

    @staticmethod
    def fit(df: DataFrame, features: Sequence[str]) -> "Scaler":
        rows = {r["feature"]: r for r in fit_table(df, features).collect()}
        return Scaler({c: rows[c]["mean"] for c in features}, {c: rows[c]["std"] for c in features})

    def column(self, c: str) -> Column:
        return (F.col(c) - F.lit(self.mean[c])) / F.lit(self.std[c])

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: self.column(c) for c in self.mean})
