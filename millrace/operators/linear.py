"""Linear models: gradient steps as aggregations, closed-form fits and one-vs-rest classifiers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.scaling import Scaler


@dataclass(frozen=True)
class Weights:
    coefficients: tuple[float, ...]
    intercept: float


@dataclass(frozen=True)
class Schedule:
    """Step size and penalty; ``power`` lets the step decay as eta / t ** power."""

    eta: float
    alpha: float
    power: float = 0.0
    averaged: bool = False

    def step(self, t: int) -> float:
        return self.eta / t**self.power


# Step sizes and penalties of the regressors.
RAW = Schedule(eta=1e-4, alpha=1e-3)
SCALED = Schedule(eta=1e-4, alpha=1e-3)
DECAYING = Schedule(eta=1e-3, alpha=1e-4, power=0.25)
DECAYING_AVERAGED = replace(DECAYING, averaged=True)


def predicted(features: Sequence[str], weights: Weights) -> Column:
    terms = [F.lit(float(w)) * F.col(c) for w, c in zip(weights.coefficients, features)]
    return reduce(lambda a, b: a + b, terms, F.lit(float(weights.intercept)))


def gradient_step(
    df: DataFrame, features: Sequence[str], target: str, weights: Weights, eta: float, alpha: float
) -> DataFrame:
    """One step of squared loss with an L2 penalty over all rows, as a one-row table of new weights."""
    error = predicted(features, weights) - F.col(target)
    shrink = 1.0 - eta * alpha
    moved = [
        (F.lit(w * shrink) - F.lit(eta) * F.avg(error * F.col(c))).alias(f"w_{i}")
        for i, (w, c) in enumerate(zip(weights.coefficients, features))
    ]
    return df.agg(*moved, (F.lit(weights.intercept) - F.lit(eta) * F.avg(error)).alias("b"))


@dataclass(frozen=True)
class Moments:
    """Sums of products of (features, 1) and of the target, one set per mini-batch that has rows."""

    n: np.ndarray
    products: np.ndarray
    target: np.ndarray
    target_square: np.ndarray

    def mse(self, w: np.ndarray) -> float:
        """Mean squared error over all rows; infinite where the sums overflow."""
        with np.errstate(all="ignore"):
            total = w @ self.products.sum(0) @ w - 2 * (w @ self.target.sum(0)) + self.target_square.sum()
            return float(total / self.n.sum()) if np.isfinite(total) else float("inf")


BATCHES = 256


def moments(df: DataFrame, features: Sequence[str], target: str, key: Sequence[str] | None = None, batches: int = BATCHES) -> Moments:
    """One aggregation over all rows: what every step of a squared-loss descent needs to know of them.

    A row's mini-batch is the hash of its ``key`` (the features and the target if none is given), so it
    depends neither on partitions nor on order. ``batches`` sets of (features + 2) squared over two sums
    are all that reaches the driver, at any number of rows. Rows with a missing value are left out; a
    table without rows gives no sets.
    """
    names = list(key or [*features, target])
    text = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in names]))
    number = F.conv(F.substring(text, 1, 4), 16, 10).cast("int") % batches
    x = [F.col(c).cast("double").alias(f"x_{i}") for i, c in enumerate(features)]
    rows = df.select(number.alias("b"), *x, F.lit(1.0).alias(f"x_{len(x)}"), F.col(target).cast("double").alias("y")).na.drop()
    size = len(x) + 1
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    found = rows.groupBy("b").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("y") * F.col("y")).alias("yy"),
        *[F.sum(F.col(f"x_{i}") * F.col("y")).alias(f"y_{i}") for i in range(size)],
        *[F.sum(F.col(f"x_{i}") * F.col(f"x_{j}")).alias(f"m_{i}_{j}") for i, j in pairs],
    ).orderBy("b").collect()
    products = np.zeros((len(found), size, size))
    for i, j in pairs:
        products[:, i, j] = products[:, j, i] = [r[f"m_{i}_{j}"] for r in found]
    goals = np.array([[r[f"y_{i}"] for i in range(size)] for r in found]).reshape(len(found), size)
    return Moments(np.array([r["n"] for r in found]), products, goals, np.array([r["yy"] for r in found]))


def descend_moments(sums: Moments, schedule: Schedule, passes: int, start: Weights, gain: int = 16) -> Weights:
    """Mini-batch descent over the sums: one step per mini-batch, ``passes`` times through all of them.

    A step takes the mean gradient of its mini-batch and counts as ``gain`` rows, however many rows the
    mini-batch has, so the weights are alike at every size. Averaged schedules give the mean of the
    weights after each step. A pass that ends with a greater error than ``start`` has, or overflows, is
    undone and ends the descent.
    """
    w = np.array([*start.coefficients, start.intercept])
    worst, kept, mean, steps = sums.mse(w), w, np.zeros(len(w)), 0
    if not np.isfinite(worst):
        return start
    decay = np.array([schedule.alpha * gain] * (len(w) - 1) + [0.0])
    for _ in range(passes):
        with np.errstate(all="ignore"):
            for n, products, goal in zip(sums.n, sums.products, sums.target):
                eta = schedule.step(1 + gain * steps)
                w = w * (1.0 - eta * decay) - eta * gain * (products @ w - goal) / n
                steps += 1
                mean = mean + (w - mean) / steps
        ends = mean if schedule.averaged else w
        if not np.isfinite(ends).all() or sums.mse(ends) > worst:
            break
        kept = ends
    return Weights(tuple(map(float, kept[:-1])), float(kept[-1]))


def descend(
    df: DataFrame, features: Sequence[str], target: str, schedule: Schedule, passes: int,
    start: Weights | None = None, key: Sequence[str] | None = None, batches: int = BATCHES, gain: int = 16,
) -> Weights:
    """Mini-batch descent on the squared loss over all rows of ``df``, which are read once."""
    sums = moments(df, features, target, key, batches)
    start = start or Weights((0.0,) * len(features), 0.0)
    return descend_moments(sums, schedule, passes, start, gain) if len(sums.n) else start


@dataclass(frozen=True)
class LinearModel:
    """A fitted regressor: weights over scaled features."""

    features: tuple[str, ...]
    scaler: Scaler
    weights: Weights

    def prediction(self) -> Column:
        terms = [
            F.lit(float(w)) * self.scaler.column(c) for w, c in zip(self.weights.coefficients, self.features)
        ]
        return reduce(lambda a, b: a + b, terms, F.lit(float(self.weights.intercept)))


def solved(sums: Moments, alpha: float) -> Weights:
    """Ridge weights from the sums: half the mean squared error plus ``alpha`` / 2 times the squared weights is least."""
    n = sums.n.sum()
    products, goal = sums.products.sum(0) / n, sums.target.sum(0) / n
    penalty = np.diag([alpha] * (len(goal) - 1) + [0.0])
    w = np.linalg.lstsq(products + penalty, goal, rcond=None)[0]
    return Weights(tuple(map(float, w[:-1])), float(w[-1]))


def fit_least_squares(df: DataFrame, features: Sequence[str], target: str, alpha: float = 1e-3) -> LinearModel:
    """Closed-form ridge fit on scaled features: one pass for the scales, one for the sums."""
    scaler = Scaler.fit(df, features)
    rows = scaler.transform(df.select(*features, F.col(target).cast("double").alias("_target")))
    return LinearModel(tuple(features), scaler, solved(moments(rows, features, "_target"), alpha))


def fit_variants(
    df: DataFrame, features: Sequence[str], target: str, passes: int, last: Schedule = DECAYING,
    key: Sequence[str] | None = None,
) -> dict[str, LinearModel]:
    """Each regressor in four forms: raw features, scaled, scaled with a decaying step, and closed form.

    The raw form takes its fixed step on unscaled inputs, which need not converge: it then keeps its
    zero weights. The rows are read three times in all: scales, sums of the raw and of the scaled features.
    """
    names = tuple(features)
    scaler = Scaler.fit(df, features)
    plain = Scaler({c: 0.0 for c in features}, {c: 1.0 for c in features})
    zero = Weights((0.0,) * len(names), 0.0)
    raw, scaled = (moments(rows, features, target, key) for rows in (df, scaler.transform(df)))
    return {
        "raw": LinearModel(names, plain, descend_moments(raw, RAW, passes, zero, gain=1)),
        "scaled": LinearModel(names, scaler, descend_moments(scaled, SCALED, passes, zero)),
        "decaying": LinearModel(names, scaler, descend_moments(scaled, last, passes, zero)),
        "closed_form": LinearModel(names, scaler, solved(scaled, alpha=1e-3)),
    }


def best_class(scores: dict[str, Column]) -> Column:
    """Name of the greatest score, the first in text order on a tie."""
    entries = [F.struct((-score).alias("s"), F.lit(name).alias("name")) for name, score in sorted(scores.items())]
    return F.array_min(F.array(*entries))["name"]


@dataclass(frozen=True)
class Classifier:
    """One-vs-rest logistic model: weights per class over raw features, classes in text order."""

    features: tuple[str, ...]
    classes: tuple[str, ...]
    weights: tuple[Weights, ...]

    def probabilities(self) -> dict[str, Column]:
        """Score of each class, scaled to sum to one over the classes."""
        scores = [1 / (1 + F.exp(-predicted(self.features, w))) for w in self.weights]
        total = reduce(lambda a, b: a + b, scores)
        return {c: score / total for c, score in zip(self.classes, scores)}

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``predicted`` and a score column per class, ``score_0`` ..."""
        scores = self.probabilities()
        columns = [score.alias(f"score_{i}") for i, score in enumerate(scores.values())]
        return df.select(*df.columns, best_class(scores).alias("predicted"), *columns)


@dataclass(frozen=True)
class LogisticFit:
    """A fitted classifier, the passes over the rows that it took, and whether every class converged."""

    model: Classifier
    rounds: int
    converged: bool


def _curvature(rows: DataFrame, label: str, size: int, at: dict[str, np.ndarray]) -> dict[str, tuple[float, np.ndarray, np.ndarray]]:
    """Mean log loss, gradient and curvature of each class at its weights, over ``x_0`` ...: one aggregation for all."""
    x = [f"x_{i}" for i in range(size)]
    entries = [F.struct(F.lit(c).alias("class"), *[F.lit(float(v)).alias(f"w_{i}") for i, v in enumerate(w)]) for c, w in at.items()]
    each = rows.select(label, *x, F.explode(F.array(*entries)).alias("m"))
    margin = reduce(lambda a, b: a + b, [F.col(f"m.w_{i}") * F.col(x[i]) for i in range(size)])
    each = each.select("m.class", *x, (F.col(label) == F.col("m.class")).cast("double").alias("y"), margin.alias("z"))
    p = 1 / (1 + F.exp(-F.col("z")))
    loss = F.greatest("z", F.lit(0.0)) - F.col("y") * F.col("z") + F.log1p(F.exp(-F.abs("z")))
    each = each.select("class", *x, (p - F.col("y")).alias("e"), (p * (1 - p)).alias("h"), loss.alias("loss"))
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    found = each.groupBy("class").agg(
        F.avg("loss").alias("loss"), *[F.avg(F.col("e") * F.col(x[i])).alias(f"g_{i}") for i in range(size)],
        *[F.avg(F.col("h") * F.col(x[i]) * F.col(x[j])).alias(f"h_{i}_{j}") for i, j in pairs],
    ).collect()
    out = {}
    for r in found:
        curved = np.zeros((size, size))
        for i, j in pairs:
            curved[i, j] = curved[j, i] = r[f"h_{i}_{j}"]
        out[r["class"]] = (r["loss"], np.array([r[f"g_{i}"] for i in range(size)]), curved)
    return out


def fit_logistic(
    df: DataFrame, features: Sequence[str], label: str, alpha: float = 1e-3, rounds: int = 50, near: float = 1e-9
) -> LogisticFit:
    """One-vs-rest log loss with an L2 penalty on the scaled weights, by Newton steps from zero.

    A round is one aggregation over all rows for all classes that still move; classes times
    (features + 2) squared over two numbers reach the driver. A step after which the loss is greater is
    halved. A class ends when no weight moves by more than ``near``; one without an optimum (all
    rows of one class) ends after ``rounds`` and is reported. The result depends on the rows alone, not on
    their order. Rows with a missing value are left out; a table without rows gives no classes.
    """
    used = df.select(label, *features).na.drop()
    names = [r[0] for r in used.select(label).distinct().orderBy(label).collect()]
    if not names:
        return LogisticFit(Classifier(tuple(features), (), ()), 0, True)
    scaler = Scaler.fit(used, features)
    size = len(features) + 1
    rows = used.select(label, *[scaler.column(c).alias(f"x_{i}") for i, c in enumerate(features)], F.lit(1.0).alias(f"x_{size - 1}"))
    penalty = np.array([alpha] * (size - 1) + [0.0])
    at, best, done = {c: np.zeros(size) for c in names}, {}, 0
    moving = set(names)
    while moving and done < rounds:
        done += 1
        for c, (loss, gradient, curved) in _curvature(rows, label, size, {c: at[c] for c in names if c in moving}).items():
            w = at[c]
            loss += penalty @ (w * w) / 2
            if c in best and loss > best[c][0] + 1e-12:
                at[c] = (w + best[c][1]) / 2
                continue
            best[c] = (loss, w)
            step = np.linalg.lstsq(curved + np.diag(penalty), gradient + penalty * w, rcond=None)[0]
            at[c] = w - step
            if np.abs(step).max() <= near:
                moving.discard(c)
    weights = []
    for c in names:
        w = best[c][1] if c in moving else at[c]
        raw = [float(v) / scaler.std[f] for f, v in zip(features, w)]
        weights.append(Weights(tuple(raw), float(w[-1]) - sum(v * scaler.mean[f] for f, v in zip(features, raw))))
    return LogisticFit(Classifier(tuple(features), tuple(names), tuple(weights)), done, not moving)


def fit_classifier(df: DataFrame, features: Sequence[str], label: str, alpha: float = 1e-3) -> Classifier:
    """The classifier of ``fit_logistic``."""
    return fit_logistic(df, features, label, alpha).model
