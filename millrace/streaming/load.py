"""The fact table, the daily mart and model updates, fed by streams."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from millrace import schemas
from millrace.functions import clean
from millrace.operators import fact, linear
from millrace.operators.linear import Weights
from millrace.operators.state import latest_state
from millrace.operators.upsert import KEY, insert_new, keyed, upsert
from millrace.plans.changes import ChangeLog
from millrace.session import written
from millrace.sources import dimensions
from millrace.streaming.runs import BatchFolders, Snapshots, per_batch

SETTLE = dt.timedelta(seconds=max(schemas.MES_TOLERANCE_S, schemas.SCADA_TOLERANCE_S))
TOPIC_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampType()),
    T.StructField("machine_id", T.StringType()), T.StructField("topic", T.StringType()),
    T.StructField("temperature_c", T.DoubleType()), T.StructField("vibration_mm_s", T.DoubleType()),
    T.StructField("pressure_bar", T.DoubleType()), T.StructField("power_kw", T.DoubleType()),
    T.StructField("machine_status", T.StringType()), T.StructField("alarm_code", T.StringType()),
    T.StructField("operator_id", T.IntegerType()), T.StructField("units_produced", T.IntegerType()),
    T.StructField("defective_units", T.IntegerType()), T.StructField("production_time_min", T.DoubleType()),
])
# Folder dates are in the session time zone, collected times in that of the process.
ONE_DAY = dt.timedelta(days=1)
MARK_SCHEMA = T.StructType([T.StructField("newest", T.TimestampType())])
FEED_KEY = ["event_id", "ts", "machine_id"]


class FactLoader:
    """Stages arriving rows by day and batch and inserts each sensor row once its matches are settled.

    A sensor row is loaded when an event at least the largest tolerance newer has been seen; by
    then, for input in time order, its nearest rows have arrived. A batch reads only the days
    from shortly before its oldest unsettled row on. Every step can be repeated for the same batch.
    Rows without time or machine are kept apart, beside the staged ones. Of rows with the same time
    and machine the one that arrived first counts (the smallest ``event_id`` within a load).
    """

    def __init__(
        self, spark: SparkSession, folder: str, table: str, after: Callable[[str], None] | None = None, log: ChangeLog | None = None,
    ):
        """``after`` is called with the first day a batch may have changed; ``log`` is told the days that it did touch."""
        self.spark, self.table, self.after, self.log = spark, table, after, log
        self.staged = BatchFolders(spark, f"{folder}/rows", TOPIC_SCHEMA)
        self.marks = Snapshots(spark, f"{folder}/marks", MARK_SCHEMA)

    def load(self, rows: DataFrame, batch: int) -> None:
        arriving = written(rows.select(*[f.name for f in TOPIC_SCHEMA.fields]), "arriving")
        arriving = keyed(arriving, self.staged.path)
        oldest, newest = arriving.agg(F.min("ts"), F.max("ts")).first()
        if oldest is None:
            return
        self.staged.write(arriving, batch)
        mark = self.marks.before(batch).first()
        high = newest if mark is None else max(newest, mark["newest"])
        # From the rows that were not settled before, or from a late row of this batch, on.
        low = oldest if mark is None else min(oldest, mark["newest"] - SETTLE)
        staged = self.staged.read(since=(low - SETTLE - ONE_DAY).date().isoformat())
        staged = staged.where(F.col("ts").between(F.lit(low - SETTLE), F.lit(high)))
        parts = {t: staged.where(F.col("topic") == t).select(*FEED_KEY, *schemas.FEED_COLUMNS[t]) for t in schemas.FEED_COLUMNS}
        settled = F.col("ts").between(F.lit(low), F.lit(high - SETTLE))
        iot = parts["iot"].where(settled)
        first = iot.groupBy("ts", "machine_id").agg(F.min_by(F.struct(*iot.columns), "event_id").alias("r")).select("r.*")
        fused = fact.fuse(first, parts["mes"], parts["scada"])
        seeds = [dimensions.seed(self.spark, name) for name in ("machine_status", "alarm_codes")]
        days = insert_new(fact.enrich(fused, *seeds), self.table, version=("temperature_c",))
        if self.log is not None:
            self.log.write(days, f"batch-{batch}")
        if self.after is not None:
            self.after((low - ONE_DAY).date().isoformat())
        self.marks.write(self.spark.createDataFrame([(high,)], MARK_SCHEMA), batch)

    def writer(self, topics: DataFrame) -> DataStreamWriter:
        return per_batch(topics, self.load)


def daily_units(mes: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Units per machine and day of a stream; a day leaves when the watermark passes its end."""
    days = mes.withWatermark("ts", delay).groupBy("machine_id", F.window("ts", "1 day").alias("w"))
    summed = days.agg(F.sum(F.col("units_produced").cast("long")).alias("units_produced"))
    return summed.select("machine_id", F.to_date("w.start").alias("day"), "units_produced")


def roll_up(daily: DataFrame, grain: str) -> DataFrame:
    """Weeks or months from the daily partial sums."""
    return daily.groupBy("machine_id", clean.period("day", grain).alias("period")).agg(F.sum("units_produced").alias("units_produced"))


def score_ready(state: DataFrame, features: Sequence[str], weights: Weights, digits: int) -> DataFrame:
    """Rounded predictions of the machines whose fields are all known."""
    ready = state.where(clean.has_all(features))
    return ready.select("machine_id", "ts", F.round(linear.predicted(features, weights), digits).alias("predicted"))


def keep_scores(
    topics: DataFrame, state: Snapshots, scores: BatchFolders, features: Sequence[str], weights: Weights,
    digits: int = 2, triggers: Sequence[str] = ("iot", "scada", "mes"),
) -> DataStreamWriter:
    """Each batch merges the latest state and scores the machines that reported on a trigger topic.

    The snapshots need a ``trigger_ts`` column: the time of a machine's last trigger event.
    """
    def score(changed: DataFrame, batch: int) -> None:
        changed = written(changed, "changed")
        before = state.before(batch)
        kept = before.join(changed.select("machine_id"), "machine_id", "left_anti")
        state.write(kept.unionByName(changed.select(*kept.columns)), batch)
        seen = before.select("machine_id", F.col("trigger_ts").alias("_seen"))
        fresh = changed.join(seen, "machine_id", "left").where(
            F.col("trigger_ts").isNotNull() & (F.col("_seen").isNull() | (F.col("trigger_ts") > F.col("_seen")))
        )
        scores.write(score_ready(fresh, features, weights, digits), batch)

    trigger = F.max(F.when(F.col("topic").isin(*triggers), F.col("ts"))).alias("trigger_ts")
    return per_batch(latest_state(topics, extra=(trigger,)), score, "update")


def keep_upserted(rows: DataFrame, path: str, key: Sequence[str] = KEY) -> DataStreamWriter:
    """A table by primary key in which the last write wins."""
    return per_batch(rows, lambda batch_rows, _: upsert(batch_rows, path, key))


def first_per_key(rows: DataFrame, key: Sequence[str] = KEY, delay: str = "1 hour") -> DataFrame:
    """The first row of each key as a stream; copies are recognised within ``delay``."""
    return rows.withWatermark("ts", delay).dropDuplicatesWithinWatermark(list(key))


COUNT_SCHEMA = T.StructType([T.StructField("seen", T.LongType())])


def retrain_every(rows: DataFrame, counts: Snapshots, refit: Callable[[int], None], every: int = 50) -> DataStreamWriter:
    """Call ``refit(batch)`` after each batch in which the number of messages passes a multiple of ``every``."""
    def count(batch_rows: DataFrame, batch: int) -> None:
        last = counts.before(batch).first()
        before = last["seen"] if last else 0
        seen = before + batch_rows.count()
        if seen // every > before // every:
            refit(batch)
        counts.write(counts.spark.createDataFrame([(seen,)], COUNT_SCHEMA), batch)

    return per_batch(rows, count)


def weight_schema(size: int) -> T.StructType:
    return T.StructType([T.StructField(f"w_{i}", T.DoubleType()) for i in range(size)] + [T.StructField("b", T.DoubleType())])


def keep_weights(rows: DataFrame, snapshots: Snapshots, features: Sequence[str], target: str, start: Weights, eta: float, alpha: float) -> DataStreamWriter:
    """One gradient step per batch; the weights are versioned by batch, so a repeated batch steps once."""
    def step(batch_rows: DataFrame, batch: int) -> None:
        row = snapshots.before(batch).first()
        weights = start if row is None else Weights(tuple(row[:-1]), row[-1])
        complete = batch_rows.na.drop(subset=[*features, target])
        moved = linear.gradient_step(complete, features, target, weights, eta, alpha)
        old = [*weights.coefficients, weights.intercept]
        names = [f.name for f in snapshots.schema.fields]
        snapshots.write(moved.select(*[F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in zip(names, old)]), batch)

    return per_batch(rows, step)
