"""State per machine or operator pair, kept up to date by streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.operators import affinity, state
from millrace.streaming.runs import Snapshots, per_batch


def keep_latest_state(topics: DataFrame, snapshots: Snapshots) -> DataStreamWriter:
    """The last known value of each field per machine over all topics, as snapshots."""
    def merge(changed: DataFrame, batch: int) -> None:
        kept = snapshots.before(batch).join(changed.select("machine_id"), "machine_id", "left_anti")
        snapshots.write(kept.unionByName(changed.select(*kept.columns)), batch)

    return per_batch(state.latest_state(topics), merge, "update")


def keep_operators(mes: DataFrame, snapshots: Snapshots) -> DataStreamWriter:
    """The operators each machine has seen, as snapshots."""
    def merge(changed: DataFrame, batch: int) -> None:
        kept = snapshots.before(batch).join(changed.select("machine_id", "operator_id"), ["machine_id", "operator_id"], "left_anti")
        snapshots.write(kept.unionByName(changed.select(*kept.columns)), batch)

    return per_batch(affinity.operators_of(mes), merge, "update")


AFFINITY_SCHEMA = "operator_id int, machine_id string, affinity double"


def keep_affinity(mes: DataFrame, snapshots: Snapshots, start: float = affinity.DEFAULT) -> DataStreamWriter:
    """The running affinity per pair. Each batch folds its rows alone, then onto the earlier value.

    Batches fold in arrival order and rows within a batch in event order.
    """
    def fold(rows: DataFrame, batch: int) -> None:
        old = snapshots.before(batch).withColumnRenamed("affinity", "_old")
        joined = old.join(affinity.folded(rows), affinity.PAIR, "full")
        from_value = F.coalesce("_old", F.lit(start))
        shrunk = from_value * F.pow(F.lit(0.5), F.coalesce("rows", F.lit(0)).cast("double"))
        snapshots.write(joined.select(*affinity.PAIR, (shrunk + F.coalesce("gain", F.lit(0.0))).alias("affinity")), batch)

    return per_batch(mes, fold)
