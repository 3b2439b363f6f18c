"""The live path: messages with their offsets, the fact table, the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans import jobs
from millrace.plans.changes import ChangeLog
from millrace.sources import messages
from millrace.streaming import runs
from millrace.streaming.load import TOPIC_SCHEMA, FactLoader


def loader(spark, state: str, fact: str) -> FactLoader:
    return FactLoader(spark, f"{state}/staging", fact, log=ChangeLog(spark, f"{state}/changes"))


def run(records: DataFrame, state: str, fact: str, marts: str | None = None, once: bool = True, every: str = "1 minute") -> None:
    """Load ``records`` (topic, partition, offset, value) into the table at ``fact`` and keep the marts, if named, up to date.

    Records that do not parse are left out. Offsets of the source, staged rows, marks and the change
    log lie below ``state``: the run can be stopped, or fail, and be started again with it. ``once``
    ends when all there is has been processed.
    """
    spark = records.sparkSession
    load = loader(spark, state, fact)
    rows = messages.parse_topics(records).where(~F.col("is_rejected")).select(*[f.name for f in TOPIC_SCHEMA.fields])

    def batch(arriving: DataFrame, number: int) -> None:
        load.load(arriving, number)
        if marts is not None:
            jobs.refresh_from_log(fact, marts, load.log)

    writer = runs.per_batch(rows, batch)
    if once:
        runs.resume(writer, state)
    else:
        runs.follow(writer, f"{state}/checkpoint", every).awaitTermination()
