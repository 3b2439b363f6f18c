"""Batch jobs: load the fact table and refresh all marts.

    spark-submit --py-files millrace.zip millrace/plans/jobs.py fact --iot DIR --scada DIR --mes DIR --out DIR
    spark-submit --py-files millrace.zip millrace/plans/jobs.py marts --fact DIR --out DIR [--since 2024-01-15 | --log DIR]
    spark-submit --py-files millrace.zip millrace/plans/jobs.py follow --servers HOST:PORT --state DIR --fact DIR --out DIR [--once]
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions import clean
from millrace.operators import fact, upsert
from millrace.plans import marts
from millrace.plans.changes import ChangeLog
from millrace.session import prepare, written
from millrace.sources import dimensions
from millrace.sources.files import read_feed_csv


def build_fact(iot: DataFrame, scada: DataFrame, mes: DataFrame, require_mes: bool = False, tie: str = "event_id") -> DataFrame:
    """The fused and enriched rows; the feeds may come from files, tables or JDBC."""
    spark = iot.sparkSession
    fused = fact.fuse(iot, mes, scada, require_mes=require_mes, tie=tie)
    return fact.enrich(fused, dimensions.seed(spark, "machine_status"), dimensions.seed(spark, "alarm_codes"))


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # Spark's name of the folder of a null


def refresh_marts(table: DataFrame, folder: str, since: str | None = None, days: Sequence[dt.date] | None = None) -> None:
    """Write every mart, or only the periods that hold days from ``since`` on, or that hold one of ``days``.

    The fact table (partitioned by day) is read once, for the changed days only, into a table of
    daily sums; the marts are built from that. Periods that no longer have rows are removed.
    """
    spark, base, day = table.sparkSession, f"{folder}/daily_sums", F.col("day")
    if days is not None and not days:
        return
    changed, touched = table, None
    if days is not None:
        changed, touched = table.where(day.isin(list(days))), {d.isoformat() for d in days}
    elif since is not None:
        changed = table.where(day >= F.lit(since).cast("date"))
    _replace(marts.daily_sums(changed), base, "day", since, touched)
    sums = spark.read.schema(marts.daily_sums(table).schema).parquet(base)
    for grain in marts.GRAINS:
        rows, start, periods = sums, None, None
        if days is not None:
            named = spark.createDataFrame([(d,) for d in days], "day date").select(
                F.date_trunc(grain, "day").cast("date").alias("first"), clean.period(day.cast("timestamp"), grain).cast("string").alias("period")
            ).distinct().collect()
            rows = sums.where(F.date_trunc(grain, day).cast("date").isin([r["first"] for r in named]))
            periods = {r["period"] for r in named}
        elif since is not None:
            low = F.lit(since).cast("timestamp")
            rows = sums.where(day >= F.date_trunc(grain, low).cast("date"))
            start = spark.range(1).select(clean.period(low, grain).cast("string")).first()[0]
        for report in marts.MARTS:
            _replace(marts.from_daily(rows, report, grain), f"{folder}/{report}_{grain}", "period", start, periods)


def _replace(rows: DataFrame, path: str, partition: str, start: str | None, touched: set[str] | None = None) -> None:
    """Write the partitions of ``rows``; remove those that it lacks among ``touched``, or from ``start`` on, or among all."""
    spark = rows.sparkSession
    rows = written(rows, "replacing")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    present = {r["p"] or NO_VALUE for r in rows.select(F.col(partition).cast("string").alias("p")).distinct().collect()}
    for value in upsert.child_folders(spark, path, partition):
        stale = value in touched if touched is not None else start is None or value >= start
        if stale and value not in present:
            upsert.remove(spark, f"{path}/{partition}={value}")


def refresh_from_log(fact_path: str, folder: str, log: ChangeLog) -> list[dt.date]:
    """Refresh the marts for the days that loads have named since the last refresh."""
    return log.consume(lambda days: refresh_marts(log.spark.read.parquet(fact_path), folder, days=days))


def numbered(rows: DataFrame) -> DataFrame:
    """Feeds without a record id get one from their values, so that ties fall the same way in every run."""
    return rows.withColumn("event_id", F.xxhash64(*rows.columns).cast("decimal(20,0)"))


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser()
    commands = parser.add_subparsers(dest="command", required=True)
    load = commands.add_parser("fact")
    for feed in ("iot", "scada", "mes"):
        load.add_argument(f"--{feed}", required=True)
    load.add_argument("--out", required=True)
    load.add_argument("--source-tz", default="UTC")
    load.add_argument("--require-mes", action="store_true")
    refresh = commands.add_parser("marts")
    refresh.add_argument("--fact", required=True)
    refresh.add_argument("--out", required=True)
    refresh.add_argument("--since")
    refresh.add_argument("--log", help="change log of the loads: refresh what they touched")
    follow = commands.add_parser("follow")
    follow.add_argument("--servers", required=True)
    follow.add_argument("--state", required=True)
    follow.add_argument("--fact", required=True)
    follow.add_argument("--out", required=True)
    follow.add_argument("--per-trigger", type=int, default=1_000_000)
    follow.add_argument("--once", action="store_true", help="process what there is, then stop")
    options = parser.parse_args(arguments)
    spark = prepare(SparkSession.builder.appName(f"millrace-{options.command}").getOrCreate())
    if options.command == "fact":
        feeds = {
            feed: clean.with_key(numbered(read_feed_csv(spark, getattr(options, feed), feed, source_tz=options.source_tz)))
            for feed in ("iot", "scada", "mes")
        }
        rows = build_fact(**feeds, require_mes=options.require_mes)
        upsert.insert_new(rows, options.out, version=("temperature_c",))
    elif options.command == "follow":
        from millrace.sources import messages
        from millrace.streaming import live

        records = messages.kafka_messages(spark, options.servers, list(schemas.TOPICS.values()), per_trigger=options.per_trigger)
        live.run(records, options.state, options.fact, options.out, once=options.once)
    elif options.log:
        refresh_from_log(options.fact, options.out, ChangeLog(spark, options.log))
    else:
        refresh_marts(spark.read.parquet(options.fact), options.out, options.since)


if __name__ == "__main__":
    main()
