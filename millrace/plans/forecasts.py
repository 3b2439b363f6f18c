"""Forecasts of state, alarm, power and production from each machine's latest values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from millrace.functions import clean
from millrace.operators import align, linear
from millrace.operators.linear import Classifier, LinearModel, Weights
from millrace.operators.scaling import Scaler
from millrace.session import written

# Digits a forecast is rounded to.
TARGETS = {"power_kw": 2, "units_produced": 0, "defective_units": 0, "production_time_min": 0}
FEATURES = {t: align.POWER_FEATURES if t == "power_kw" else align.UNITS_FEATURES for t in TARGETS}
# The last variant of a target: defects average their steps, minutes take a smaller one.
LAST_VARIANT = {
    "power_kw": linear.DECAYING,
    "units_produced": linear.DECAYING,
    "defective_units": linear.DECAYING_AVERAGED,
    "production_time_min": linear.Schedule(eta=1e-4, alpha=1e-4, power=0.25),
}
PASSES = 11


def coded_state(state: DataFrame, codes: DataFrame) -> DataFrame:
    """Latest values with the ratios and codes the models were trained on."""
    return align.coded(align.with_ratios(state), codes)


def fit_target(training: DataFrame, target: str, passes: int = PASSES) -> dict[str, LinearModel]:
    """The three gradient-trained variants and the closed-form fit of one target."""
    features = FEATURES[target]
    rows = written(align.complete(training, [*features, target]).select(*align.KEY, *features, target), "training")
    return linear.fit_variants(rows, features, target, passes, LAST_VARIANT[target], align.KEY)


def forecast(state: DataFrame, target: str, models: Mapping[str, LinearModel]) -> DataFrame:
    """Every model's rounded forecast beside the current value; null while a needed field is missing."""
    ready = clean.has_all(FEATURES[target])
    columns = [
        F.when(ready, F.round(model.prediction(), TARGETS[target])).alias(f"predicted_{name}") for name, model in models.items()
    ]
    return state.select("machine_id", F.col(target).alias("current"), *columns)


def forecast_class(state: DataFrame, label: str, model: Classifier) -> DataFrame:
    """Predicted and current class of each machine whose inputs are complete."""
    ready = state.where(clean.has_all(align.STATE_FEATURES))
    return model.transform(ready).select("machine_id", "predicted", F.col(label).alias("current"))


ROWS = "class string, position int, feature string, weight double, mean double, std double, intercept double"


def _lines(name: str | None, features, weights: Weights, scaler: Scaler) -> list[tuple]:
    return [
        (name, i, c, float(w), float(scaler.mean[c]), float(scaler.std[c]), float(weights.intercept))
        for i, (c, w) in enumerate(zip(features, weights.coefficients))
    ]


def lines(model: LinearModel | Classifier) -> list[tuple]:
    """A model as rows of ``ROWS``: one per class and feature, the intercept in each."""
    if isinstance(model, LinearModel):
        return _lines(None, model.features, model.weights, model.scaler)
    plain = Scaler({c: 0.0 for c in model.features}, {c: 1.0 for c in model.features})
    return [line for name, w in zip(model.classes, model.weights) for line in _lines(name, model.features, w, plain)]


def from_lines(rows: Sequence[Row]) -> LinearModel | Classifier:
    """The model of rows in order of class and position."""
    classes = list(dict.fromkeys(r["class"] for r in rows))
    groups = [[r for r in rows if r["class"] == c] for c in classes]
    weights = [Weights(tuple(r["weight"] for r in g), g[0]["intercept"]) for g in groups]
    features = tuple(r["feature"] for r in groups[0])
    if classes != [None]:
        return Classifier(features, tuple(classes), tuple(weights))
    return LinearModel(features, Scaler({r["feature"]: r["mean"] for r in rows}, {r["feature"]: r["std"] for r in rows}), weights[0])


def save(model: LinearModel | Classifier, spark: SparkSession, path: str) -> None:
    """A model as a small table."""
    spark.createDataFrame(lines(model), ROWS).coalesce(1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> LinearModel | Classifier:
    return from_lines(spark.read.schema(ROWS).parquet(path).orderBy("class", "position").collect())
