"""Exact quantiles with linear interpolation, without holding a group in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.scan import cut_slices, running_sum, value_slice


def exact_quantiles(
    df: DataFrame, by: Sequence[str], value: str, quantiles: Mapping[str, float], width: float | None = 0.01
) -> DataFrame:
    """One row per key with a column per entry of ``quantiles``.

    Equal values collapse to one counted row, a running count over the values (cut into slices of
    ``width``, best the precision of the values, or without it into even slices by a sketch, for values
    that crowd) gives their ranks, and the two order statistics next to each quantile are picked. Keys must not be null; null values do not count.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    if width is None:
        counted = cut_slices(counted, by, value, "_part")
    slice_ = F.col("_part") if width is None else value_slice(value, width)
    rows = running_sum(counted, by, [value], slice_, "_upto", F.col("_n"), total="_all")
    picks, result = [], []
    for name, q in quantiles.items():
        at = F.lit(float(q)) * (F.col("_all") - 1)
        picks.append(F.min(F.when(F.col("_upto") > F.floor(at), F.col(value))).alias(f"_lo_{name}"))
        picks.append(F.min(F.when(F.col("_upto") > F.ceil(at), F.col(value))).alias(f"_hi_{name}"))
        share = at - F.floor(at)
        result.append((F.col(f"_lo_{name}") + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * share).alias(name))
    return rows.groupBy(*by, "_all").agg(*picks).select(*by, F.col("_all").alias("n"), *result)
