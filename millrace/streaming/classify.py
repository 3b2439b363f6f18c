"""State and alarm classes on a stream: predictions before, and one log-loss step after, each batch."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from millrace.functions import clean
from millrace.operators import align, linear
from millrace.operators.linear import Classifier, Weights
from millrace.operators.scaling import Scaler
from millrace.operators.scan import Fill, fill, time_slice
from millrace.session import written
from millrace.streaming.runs import BatchFolders, Snapshots, per_batch

ORDER = ["ts", "event_id"]
INPUTS = ["power_kw", "temperature_c", "vibration_mm_s", "pressure_bar"]
LABELS = ["machine_status", "alarm_code"]
TRIGGERS = ("iot", "scada")
PREDICTED = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("machine_id", T.StringType()), T.StructField("ts", T.TimestampType()),
    T.StructField("predicted", T.StringType()), T.StructField("actual", T.StringType()),
])


def state_schema() -> T.StructType:
    kinds = [T.DoubleType()] * len(INPUTS) + [T.StringType()] * len(LABELS)
    return T.StructType([
        T.StructField("machine_id", T.StringType()), T.StructField("ts", T.TimestampType()), T.StructField("event_id", T.LongType()),
        *[T.StructField(c, kind) for c, kind in zip([*INPUTS, *LABELS], kinds)],
    ])


def weight_schema(size: int) -> T.StructType:
    return T.StructType([T.StructField("class", T.StringType()), *[T.StructField(f"w_{i}", T.DoubleType()) for i in range(size)], T.StructField("b", T.DoubleType())])


def as_of_state(rows: DataFrame, before: DataFrame, slice_s: int = 86_400) -> DataFrame:
    """Every event of ``rows`` with the last known fields of its machine, those of ``before`` (one row per machine) included."""
    normal = rows.withColumn("alarm_code", clean.norm_alarm("alarm_code"))
    names = ["machine_id", *ORDER, *INPUTS, *LABELS]
    known = before.select(*names).withColumn("topic", F.lit(None).cast("string"))
    both = normal.select(*names, "topic").unionByName(known)
    return fill(both, ["machine_id"], ORDER, time_slice("ts", slice_s), [Fill(c, c) for c in [*INPUTS, *LABELS]])


def last_state(filled: DataFrame) -> DataFrame:
    rest = [*ORDER, *INPUTS, *LABELS]
    last = filled.groupBy("machine_id").agg(F.max_by(F.struct(*rest), F.struct(*ORDER)).alias("r"))
    return last.select("machine_id", "r.*").select(*[f.name for f in state_schema().fields])


def log_loss_step(rows: DataFrame, features: Sequence[str], label: str, model: Classifier, eta: float, alpha: float) -> Classifier:
    """One step of one-vs-rest log loss with an L2 penalty over all rows: one aggregation for all classes and features."""
    sums = []
    for k, (name, weights) in enumerate(zip(model.classes, model.weights)):
        error = 1 / (1 + F.exp(-linear.predicted(features, weights))) - (F.col(label) == name).cast("double")
        sums += [F.avg(error * F.col(c)).alias(f"g_{k}_{i}") for i, c in enumerate(features)] + [F.avg(error).alias(f"g_{k}_b")]
    found = rows.agg(*sums).first()
    if found["g_0_b"] is None:
        return model
    moved = []
    for k, weights in enumerate(model.weights):
        steps = [w * (1 - eta * alpha) - eta * found[f"g_{k}_{i}"] for i, w in enumerate(weights.coefficients)]
        moved.append(Weights(tuple(steps), weights.intercept - eta * found[f"g_{k}_b"]))
    return Classifier(model.features, model.classes, tuple(moved))


@dataclass
class OnlineClassifier:
    """Keeps a one-vs-rest model of ``label`` over the events of a stream.

    A batch fills each event with the last known fields of its machine, classifies the events of
    trigger topics whose inputs are complete by the weights of the batch before, and then takes one
    step over those that have a label. State, weights and predictions are versioned by batch, so a
    repeated batch changes nothing. Features are the machine's code and the scaled inputs.
    """

    spark: SparkSession
    folder: str
    label: str
    classes: Sequence[str]
    codes: DataFrame
    scaler: Scaler
    eta: float = 0.1
    alpha: float = 1e-4

    def __post_init__(self):
        self.features = ("machine_code", *INPUTS)
        self.state = Snapshots(self.spark, f"{self.folder}/state", state_schema())
        self.weights = Snapshots(self.spark, f"{self.folder}/weights", weight_schema(len(self.features)))
        self.predictions = BatchFolders(self.spark, f"{self.folder}/predictions", PREDICTED)

    def model(self, batch: int) -> Classifier:
        """The weights before a batch: one row per class of the label."""
        kept = {r["class"]: r for r in self.weights.before(batch).collect()}
        names = sorted(self.classes)
        start = Weights((0.0,) * len(self.features), 0.0)
        weights = [Weights(tuple(kept[c][1:-1]), kept[c][-1]) if c in kept else start for c in names]
        return Classifier(self.features, tuple(names), tuple(weights))

    def step(self, rows: DataFrame, batch: int) -> None:
        filled = written(as_of_state(rows, self.state.before(batch)), "filled")
        events = filled.where(F.col("topic").isin(*TRIGGERS) & clean.has_all(INPUTS))
        ready = written(self.scaler.transform(align.coded(events, self.codes)).where(F.col("machine_code").isNotNull()), "ready")
        model = self.model(batch)
        chosen = linear.best_class(model.probabilities())
        self.predictions.write(ready.select("event_id", "machine_id", "ts", chosen.alias("predicted"), F.col(self.label).alias("actual")), batch)
        moved = log_loss_step(ready.where(F.col(self.label).isNotNull()), self.features, self.label, model, self.eta, self.alpha)
        rows = [(c, *w.coefficients, w.intercept) for c, w in zip(moved.classes, moved.weights)]
        self.weights.write(self.spark.createDataFrame(rows, self.weights.schema), batch)
        self.state.write(last_state(filled), batch)

    def writer(self, topics: DataFrame) -> DataStreamWriter:
        return per_batch(topics, self.step)
