"""Quality measures of predictions and clusterings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.clean import clip
from millrace.functions.kpis import ratio
from millrace.operators.scan import cut_slices, running_sum, time_slice, value_slice
from millrace.session import written


def _total(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def regression(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    error = F.col(predicted) - F.col(actual)
    sums = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(actual).alias("_spread"),
        F.avg(error).alias("error_mean"),
        F.stddev_pop(error).alias("error_std"),
        F.min(error).alias("error_min"),
        F.max(error).alias("error_max"),
    )
    return sums.select(
        "n", "mse", "mae", F.sqrt("mse").alias("rmse"), (F.lit(1.0) - F.try_divide("mse", "_spread")).alias("r2"),
        "error_mean", "error_std", "error_min", "error_max",
    )


def classification(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Accuracy and precision, recall and F1 weighted by class support; an undefined ratio counts 0."""
    cells = df.groupBy(F.col(actual).alias("y"), F.col(predicted).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    cells = written(cells, "confusion")
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(F.lit(0))
    truth = cells.groupBy("y").agg(F.sum("n").alias("support"), F.sum(hit).alias("hits"))
    guesses = cells.groupBy("p").agg(F.sum("n").alias("guessed"))
    classes = truth.join(guesses, F.col("y") == F.col("p"), "left")
    precision = F.coalesce(ratio("hits", "guessed"), F.lit(0.0))
    recall = F.coalesce(ratio("hits", "support"), F.lit(0.0))
    scored = classes.withColumn("precision", precision).withColumn("recall", recall)
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
    scored = scored.withColumn("f1", f1)

    def weighted(c: str) -> Column:
        return (F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c)

    accuracy = ratio(F.sum("hits"), F.sum("support")).alias("accuracy")
    return scored.agg(F.sum("support").alias("n"), accuracy, weighted("precision"), weighted("recall"), weighted("f1"))


def auc_one_vs_rest(df: DataFrame, actual: str, scores: dict[str, str], slices: int = 64) -> DataFrame:
    """Area under the ROC curve of each class against the rest, from average ranks of the scores.

    ``scores`` maps a class to its score column. Equal scores collapse to one counted row; ranks are
    counted over slices that are even however the scores crowd.
    """
    entries = [F.struct(F.lit(k).alias("class"), F.col(c).alias("score")) for k, c in scores.items()]
    long = df.select(actual, F.explode(F.array(*entries)).alias("e")).select(actual, "e.class", "e.score")
    positive = (F.col(actual) == F.col("class")).cast("long")
    counted = long.groupBy("class", "score").agg(F.count(F.lit(1)).alias("n"), F.sum(positive).alias("pos"))
    sliced = cut_slices(counted, ["class"], "score", "slice", slices)
    ranked = running_sum(sliced, ["class"], ["score"], F.col("slice"), "upto", F.col("n"))
    mean_rank = F.col("upto") - (F.col("n") - 1) / F.lit(2.0)
    sums = ranked.groupBy("class").agg(
        F.sum("pos").cast("double").alias("positives"), F.sum(F.col("n") - F.col("pos")).cast("double").alias("negatives"),
        F.sum(F.col("pos") * mean_rank).alias("ranks"),
    )
    above = F.col("ranks") - F.col("positives") * (F.col("positives") + 1) / F.lit(2.0)
    return sums.select("class", F.try_divide(above, F.col("positives") * F.col("negatives")).alias("auc"))


def macro_auc(df: DataFrame, actual: str, scores: dict[str, str]) -> DataFrame:
    return auc_one_vs_rest(df, actual, scores).agg(F.avg("auc").alias("auc"))


def cluster_sizes(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))


def noise_share(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    return df.agg(F.avg((F.col(cluster) == -1).cast("double")).alias("noise_share"))


def _centroids(df: DataFrame, features: Sequence[str], cluster: str) -> DataFrame:
    return df.groupBy(cluster).agg(F.array(*[F.avg(c) for c in features]).alias("centre"))


def _distance(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def calinski_harabasz(df: DataFrame, features: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Spread between against spread within clusters, from per-cluster sums; null below two clusters."""
    per = df.groupBy(cluster).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        *[F.avg(c).alias(f"m_{c}") for c in features],
        *[F.var_pop(c).alias(f"v_{c}") for c in features],
    )
    per = written(per, "clusters")
    overall = per.agg(*[(F.sum(F.col("n") * F.col(f"m_{c}")) / F.sum("n")).alias(c) for c in features])
    per = per.withColumn("o", overall.select(F.struct(*features).alias("o")).scalar())
    within = F.col("n") * _total([F.col(f"v_{c}") for c in features])
    between = F.col("n") * _total([(F.col(f"m_{c}") - F.col(f"o.{c}")) ** 2 for c in features])
    sums = per.agg(
        F.count(F.lit(1)).alias("clusters"), F.sum("n").alias("n"), F.sum(within).alias("w"), F.sum(between).alias("b")
    )
    score = F.try_divide(F.col("b") * (F.col("n") - F.col("clusters")), F.col("w") * (F.col("clusters") - 1))
    return sums.select("clusters", F.when(F.col("clusters") > 1, score).alias("calinski_harabasz"))


def davies_bouldin(df: DataFrame, features: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Mean over clusters of the worst (spread + spread) / centre distance; null below two clusters.

    The pairwise step runs inside one row that holds one entry per cluster.
    """
    centres = written(_centroids(df, features, cluster), "centres")
    placed = df.join(centres, cluster)
    spread = F.avg(_distance(F.array(*features), F.col("centre")))
    entries = placed.groupBy(cluster, "centre").agg(spread.alias("spread"))
    table = entries.agg(F.collect_list(F.struct(F.col(cluster).alias("id"), "centre", "spread")).alias("all"))

    def worst(a: Column) -> Column:
        others = F.filter("all", lambda b: b["id"] != a["id"])
        return F.array_max(F.transform(others, lambda b: F.try_divide(a["spread"] + b["spread"], _distance(a["centre"], b["centre"]))))

    k = F.size("all")
    mean = F.aggregate(F.transform("all", worst), F.lit(0.0), lambda total, x: total + x) / k
    return table.select(k.cast("long").alias("clusters"), F.when(k > 1, mean).alias("davies_bouldin"))


def silhouette_squared(df: DataFrame, features: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Mean silhouette under squared distance, in one pass over per-cluster sums (linear in the rows)."""
    norm = _total([F.col(c) * F.col(c) for c in features])
    entry = df.groupBy(cluster).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(norm).alias("squares"),
        F.array(*[F.sum(c) for c in features]).alias("sums"),
    )
    table = entry.agg(F.collect_list(F.struct(F.col(cluster).alias("id"), "n", "squares", "sums")).alias("all"))
    point = F.array(*[F.col(c) for c in features])
    rows = df.select(F.col(cluster).alias("id"), point.alias("x"), norm.alias("norm")).withColumn("all", table.scalar())

    def spread(e: Column) -> Column:
        products = F.zip_with(F.col("x"), e["sums"], lambda a, b: a * b)
        dot = F.aggregate(products, F.lit(0.0), lambda total, x: total + x)
        return e["n"] * F.col("norm") + e["squares"] - 2 * dot

    own = F.element_at(F.filter("all", lambda e: e["id"] == F.col("id")), 1)
    rows = rows.withColumn("own_n", own["n"]).withColumn("a", F.try_divide(spread(own), own["n"] - 1))
    others = F.filter("all", lambda e: e["id"] != F.col("id"))
    rows = rows.withColumn("b", F.array_min(F.transform(others, lambda e: spread(e) / e["n"])))
    score = F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b"))
    value = F.when(F.col("own_n") > 1, F.coalesce(score, F.lit(0.0))).otherwise(0.0)
    return rows.where("b is not null").agg(F.avg(value).alias("silhouette_squared"))


def silhouette(df: DataFrame, features: Sequence[str], cluster: str = "cluster", block_rows: int = 4096) -> DataFrame:
    """Mean silhouette under Euclidean distance, exact.

    The measure needs every distance, so its cost grows with the square of the distinct points;
    ``silhouette_squared`` is the linear measure for large tables. Distinct points carry their
    count, are dealt into blocks, and each pair of blocks is one small task that returns distance
    sums per point and cluster.
    """
    names = list(features)
    points = df.groupBy(F.col(cluster).cast("long").alias("cluster"), *names).agg(F.count(F.lit(1)).alias("n"))
    points = written(points, "distinct")
    blocks = max(1, -(-points.count() // block_rows))
    points = points.withColumn("point", F.struct("cluster", *names))
    points = points.withColumn("block", F.pmod(F.xxhash64("point"), F.lit(blocks)).cast("int"))
    partner = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = points.select("point.*", F.col("block").alias("i"), partner.alias("j"))
    right = points.select("point.*", "n", F.col("block").alias("j"), partner.alias("i"))

    def distances(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(b):
            x = a[names].to_numpy()
            for label, group in b.groupby("cluster"):
                gap = x[:, None, :] - group[names].to_numpy()[None, :, :]
                total = np.sqrt((gap * gap).sum(axis=2)) @ group["n"].to_numpy(dtype=float)
                out.append(a[["cluster", *names]].assign(other=label, total=total))
        return pd.concat(out) if out else pd.DataFrame(columns=["cluster", *names, "other", "total"])

    fields = ", ".join(f"{c} double" for c in names)
    partial = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInPandas(
        distances, f"cluster long, {fields}, other long, total double"
    )
    sums = partial.groupBy("cluster", *names, "other").agg(F.sum("total").alias("total"))
    sizes = written(points.groupBy(F.col("cluster").alias("other")).agg(F.sum("n").cast("double").alias("size")), "sizes")
    sums = sums.join(sizes, "other")
    own = F.col("other") == F.col("cluster")
    scored = sums.groupBy("cluster", *names).agg(
        F.max(F.when(own, F.try_divide("total", F.col("size") - 1))).alias("a"),
        F.max(F.when(own, F.col("size"))).alias("own_size"),
        F.min(F.when(~own, F.col("total") / F.col("size"))).alias("b"),
    )
    scored = scored.where("b is not null").join(points.select("cluster", *names, "n"), ["cluster", *names])
    score = F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    value = F.when(F.col("own_size") > 1, score).otherwise(0.0)
    return scored.agg((F.sum(value * F.col("n")) / F.sum("n")).alias("silhouette"))


def ellipse(df: DataFrame, x: str, y: str, cluster: str = "cluster") -> DataFrame:
    """Centre, half axes (square roots of the covariance eigenvalues) and angle of each cluster."""
    sums = df.groupBy(cluster).agg(
        F.avg(x).alias("centre_x"), F.avg(y).alias("centre_y"),
        F.var_samp(x).alias("vx"), F.var_samp(y).alias("vy"), F.covar_samp(x, y).alias("vxy"),
    )
    half, mean = (F.col("vx") - F.col("vy")) / 2, (F.col("vx") + F.col("vy")) / 2
    root = F.sqrt(half * half + F.col("vxy") * F.col("vxy"))
    angle = F.degrees(F.atan2(2 * F.col("vxy"), F.col("vx") - F.col("vy")) / 2)
    return sums.select(
        cluster, "centre_x", "centre_y", F.sqrt(mean + root).alias("major"),
        F.sqrt(F.greatest(mean - root, F.lit(0.0))).alias("minor"), angle.alias("angle_deg"),
    )


def numbered(df: DataFrame, order: Sequence[str], name: str = "n", slice_s: int = 3600) -> DataFrame:
    """Add the row number in time order (the first column of ``order`` is the time)."""
    return running_sum(df, [], order, time_slice(order[0], slice_s), name)


def time_series_folds(df: DataFrame, splits: int = 5) -> DataFrame:
    """Expanding folds in time order: fold 0 only trains; fold i is tested on what the folds below train."""
    ordered = numbered(df, ["ts", "machine_id"], "row_no")
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    size = F.floor(total / F.lit(splits + 1))
    from_end = F.floor((total - F.col("row_no")) / size)
    return ordered.withColumn("fold", F.greatest(F.lit(0), F.lit(splits) - from_end).cast("int"))


# Score bands and their wording, highest band first.
SILHOUETTE_BANDS = [
    (0.7, "Strong cluster structure"),
    (0.5, "Reasonable cluster structure"),
    (0.25, "Weak cluster structure"),
]
SILHOUETTE_ELSE = "No substantial cluster structure"
DAVIES_BOULDIN_BANDS = [
    (0.5, "Excellent cluster separation"),
    (1.0, "Good cluster separation"),
    (1.5, "Moderate cluster separation"),
]
DAVIES_BOULDIN_ELSE = "Poor cluster separation"
NOISE_BANDS = [
    (0.01, "Very low anomaly rate"),
    (0.05, "Normal operating range"),
    (0.1, "Elevated anomaly rate - investigate"),
]
NOISE_ELSE = "High anomaly rate - immediate attention needed"
HEALTH_BANDS = [(0.8, "HEALTHY"), (0.6, "STABLE"), (0.4, "DEGRADED")]
HEALTH_ELSE = "CRITICAL"


def banded(value: Column, bands: Sequence[tuple[float, str]], otherwise: str, above: bool) -> Column:
    """Text of the first band the value lies above (or below); null for a null value."""
    out = F.when(value.isNull(), F.lit(None).cast("string"))
    for limit, text in bands:
        out = out.when(value > limit if above else value < limit, text)
    return out.otherwise(otherwise)


def interpret_silhouette(value: Column) -> Column:
    return banded(value, SILHOUETTE_BANDS, SILHOUETTE_ELSE, above=True)


def interpret_davies_bouldin(value: Column) -> Column:
    return banded(value, DAVIES_BOULDIN_BANDS, DAVIES_BOULDIN_ELSE, above=False)


def interpret_noise(value: Column) -> Column:
    return banded(value, NOISE_BANDS, NOISE_ELSE, above=False)


def health_score(silhouette: Column, davies_bouldin: Column, noise: Column | None = None) -> Column:
    score = 0.4 * clip(silhouette / 0.7, 0.0, 1.0) + 0.4 * clip((2 - davies_bouldin) / 2, 0.0, 1.0)
    return score if noise is None else score + 0.2 * clip(1 - noise / 0.1, 0.0, 1.0)


def health_grade(score: Column) -> Column:
    return F.when(score.isNull(), "UNKNOWN").otherwise(banded(score, HEALTH_BANDS, HEALTH_ELSE, above=True))


def trend(current: Column, training: Column, rising: str, falling: str) -> Column:
    change = current - training
    return F.when(change > 0, rising).when(change < 0, falling).when(change == 0, "stable")
