"""Centre-based clustering: assignment, centre updates, fits of all rows and one clustering per machine."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import written

Centres = Sequence[Sequence[float]]


def squared_distance(x: Column, y: Column) -> Column:
    squares = F.zip_with(x, y, lambda a, b: (a - b) * (a - b))
    return F.aggregate(squares, F.lit(0.0), lambda total, v: total + v)


def centre_array(centres: Centres) -> Column:
    """Array of (cluster, centre) literals; the centres are model parameters."""
    return F.array(*[
        F.struct(F.lit(i).alias("cluster"), F.array(*[F.lit(float(v)) for v in c]).alias("centre"))
        for i, c in enumerate(centres)
    ])


def closest(x: Column, centres: Column) -> Column:
    """Number of the centre nearest to ``x``, the smaller number on a tie."""
    found = F.transform(
        centres, lambda c: F.struct(squared_distance(x, c["centre"]).alias("d"), c["cluster"].alias("cluster"))
    )
    return F.array_min(found)["cluster"]


def assign(df: DataFrame, features: Sequence[str], centres: Centres, name: str = "cluster") -> DataFrame:
    """Add the nearest centre of each row; a row with a missing feature gets null."""
    x = F.array(*[F.col(c).cast("double") for c in features])
    complete = ~F.exists(x, lambda v: v.isNull())
    return df.withColumn(name, F.when(complete, closest(x, centre_array(centres))))


def centre_column(centres: Centres, cluster: Column) -> Column:
    table = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centres])
    return F.get(table, cluster)


def update_centres(df: DataFrame, features: Sequence[str], cluster: str = "cluster") -> DataFrame:
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in features])


TOLERANCE = 1e-6  # squared way of the centre that moves most
ROUNDS = 300


class KMeansFit(NamedTuple):
    """Centres in the order of their coordinates; ``converged`` tells whether the last round moved none."""

    centres: list[list[float]]
    cost: float
    rounds: int
    converged: bool


def farthest_first(points: DataFrame, x: str, k: int) -> list[list[float]]:
    """Start centres without a draw: the point nearest to the mean, then always the one farthest from those chosen.

    Every choice is one aggregate over all points; of equally far ones the first in coordinate order
    counts. A table with fewer different points gives fewer centres.
    """
    size = points.agg(F.max(F.size(x))).first()[0]
    if not size or size < 0:
        return []
    mean = points.agg(*[F.avg(F.col(x)[i]) for i in range(size)]).first()
    centre = F.array(*[F.lit(float(v)) for v in mean])
    found = [list(points.agg(F.min(F.struct(squared_distance(F.col(x), centre), F.col(x)))).first()[0][1])]
    while len(found) < k:
        away = F.array_min(F.transform(centre_array(found), lambda c: squared_distance(F.col(x), c["centre"])))
        far = points.agg(F.min(F.struct((-away).alias("d"), F.col(x)))).first()[0]
        if far[0] >= 0:
            break
        found.append(list(far[1]))
    return found


def fit_kmeans(
    df: DataFrame, features: Sequence[str], k: int, tolerance: float = TOLERANCE, rounds: int = ROUNDS
) -> KMeansFit:
    """Lloyd rounds from farthest-first centres until none moves by more than ``tolerance`` (squared).

    A round is one aggregation with ``k`` groups, summed in the map tasks first, so a cluster that holds
    most rows is no hot key. Rows with a missing feature are left out; without rows there are no centres.
    """
    x = F.array(*[F.col(c).cast("double") for c in features])
    points = written(df.na.drop(subset=list(features)).select(x.alias("x")), "points")
    centres = farthest_first(points, "x", k)
    if not centres:
        return KMeansFit([], 0.0, 0, True)
    done, converged = 0, False
    while not converged and done < rounds:
        placed = points.select("x", closest(F.col("x"), centre_array(centres)).alias("cluster"))
        means = placed.groupBy("cluster").agg(F.array(*[F.avg(F.col("x")[i]) for i in range(len(features))]).alias("mean"))
        found = {r["cluster"]: list(r["mean"]) for r in means.collect()}
        moved = [found.get(i, c) for i, c in enumerate(centres)]
        way = max(sum((a - b) * (a - b) for a, b in zip(*pair)) for pair in zip(centres, moved))
        centres, done, converged = moved, done + 1, way <= tolerance
    centres = sorted(centres)
    nearest = F.array_min(F.transform(centre_array(centres), lambda c: squared_distance(F.col("x"), c["centre"])))
    return KMeansFit(centres, float(points.agg(F.sum(nearest)).first()[0]), done, converged)


def keyed_scaler(df: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """One row per key: arrays ``mean`` and ``std`` over the features; a zero deviation counts as 1."""
    def std(c: str) -> Column:
        value = F.stddev_pop(c)
        return F.when(value == 0, F.lit(1.0)).otherwise(value)

    return df.groupBy(key).agg(
        F.array(*[F.avg(c) for c in features]).alias("mean"), F.array(*[std(c) for c in features]).alias("std"),
        F.count(F.lit(1)).alias("samples"),
    )


def standardised(features: Sequence[str]) -> Column:
    """The features as an array, scaled by the row's ``mean`` and ``std`` arrays."""
    x = F.array(*[F.col(c).cast("double") for c in features])
    centred = F.zip_with(x, F.col("mean"), lambda a, m: a - m)
    return F.zip_with(centred, F.col("std"), lambda a, s: a / s)


def spread_centres(k: int, dimensions: int) -> list[list[float]]:
    """Start centres in scaled space, evenly spaced on the diagonal between -1.2 and 1.2."""
    step = 2.4 / max(1, k - 1)
    return [[-1.2 + step * i] * dimensions for i in range(k)]


def keyed_kmeans(points: DataFrame, key: str, x: str, start: Centres, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """One clustering per key, all keys at once: one row per key with its array of centres.

    Each round joins the points with their key's centres (one row per key), assigns them inside
    the row and averages per key and cluster with map-side partial sums, so a large key is spread
    over all tasks. The centres are written to the shared folder each round to end their lineage.
    The rounds end when no key's centres move by more than ``tolerance`` (squared); ``converged`` tells
    whether they did within ``rounds``.
    """
    dimensions = len(start[0])
    centres = written(points.select(key).distinct().withColumn("centres", centre_array(start)), "centres")
    converged, done = False, 0
    while not converged and done < rounds:
        placed = points.join(centres, key).withColumn("cluster", closest(F.col(x), F.col("centres")))
        means = placed.groupBy(key, "cluster").agg(
            F.array(*[F.avg(F.col(x)[i]) for i in range(dimensions)]).alias("mean")
        )
        found = means.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("cluster", "mean"))).alias("found"))
        moved = F.transform("centres", lambda c: F.struct(
            c["cluster"].alias("cluster"), F.coalesce(F.col("found")[c["cluster"]], c["centre"]).alias("centre")
        ))
        moves = F.zip_with("old", "centres", lambda a, b: squared_distance(a["centre"], b["centre"]))
        stepped = centres.join(found, key).select(key, F.col("centres").alias("old"), moved.alias("centres"))
        stepped = written(stepped.withColumn("move", F.array_max(moves)), "centres")
        centres = stepped.select(key, "centres")
        converged, done = (stepped.agg(F.max("move")).first()[0] or 0.0) <= tolerance, done + 1
    return centres.withColumn("converged", F.lit(converged))
