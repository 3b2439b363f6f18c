"""Checks of the streams: each must give the rows of its batch twin."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.checks.registry import check, feed, feeds
from millrace.operators import fact, sessions
from millrace.operators.linear import Weights
from millrace.operators.state import STATE_COLUMNS, latest_state
from millrace.operators.upsert import read_table
from millrace.session import fresh_path
from millrace.sources import events, messages
from millrace.streaming import history, load, runs
from millrace.streaming import state as kept
from millrace.streaming.nearest import stream_nearest


@contextmanager
def few_state_partitions(spark, most: int = 8):
    """A local replay keeps few state partitions; on a cluster the session's own number stands."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    if spark.sparkContext.master.startswith("local") and int(before) > most:
        spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def topic_stream(spark, folder, closed: bool = False):
    rows = events.stream_events(spark, folder)
    if closed:
        rows = rows.unionByName(events.closing_marker(spark))
    return events.by_topic({name: view(rows) for name, view in events.FEEDS.items()})


def feed_stream(spark, folder, name, closed: bool = False):
    rows = events.stream_events(spark, folder)
    if closed:
        rows = rows.unionByName(events.closing_marker(spark))
    return events.FEEDS[name](rows)


def plain_time(rows):
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c, kind in rows.dtypes if kind == "timestamp"})


@check("stream_ingest", """
SELECT topic, machine_id, count(*) AS n, max(ts) AS last_ts, sum(value) AS total FROM (
  SELECT 'iot-data' AS topic, machine_id, date_trunc('second', ts) AS ts, temperature_c AS value FROM iot
  UNION ALL SELECT 'scada-data', machine_id, date_trunc('second', ts), power_kw FROM scada
  UNION ALL SELECT 'mes-data', machine_id, date_trunc('second', ts), units_produced FROM mes) GROUP BY ALL""", doubles="total", digits=2)
def stream_ingest(spark, folder):
    """All feeds published as JSON files, then read by one stream per topic into tables."""
    path, out = fresh_path(spark, "messages"), None
    for name, rows in zip(("iot", "scada", "mes"), feeds(spark, folder)):
        messages.write_message_files(messages.publishable(rows, name), path)
    values = {"iot": "temperature_c", "scada": "power_kw", "mes": "units_produced"}
    for name, value in values.items():
        topic = schemas.TOPICS[name]
        stream = messages.message_files(spark, path, files_per_batch=1000).where(F.col("topic") == topic)
        parsed = messages.parse(stream, name).where("not is_rejected")
        table = fresh_path(spark, name)
        runs.replay(runs.to_table(parsed, table), spark, name)
        rows = spark.read.schema(parsed.schema).parquet(table)
        part = rows.select("topic", "machine_id", "ts", F.col(value).cast("double").alias("value"))
        out = part if out is None else out.unionByName(part)
    return plain_time(out.groupBy("topic", "machine_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_ts"), F.sum("value").alias("total")
    ))


def _stream_nearest(spark, folder, build, other):
    with few_state_partitions(spark):
        iot = feed_stream(spark, folder, "iot", closed=True).select("event_id", "machine_id", "ts")
        found = stream_nearest(iot, build(feed_stream(spark, folder, other, closed=True)), [])
        path = fresh_path(spark, "nearest")
        runs.replay(runs.to_table(found, path), spark, "nearest")
    return plain_time(spark.read.schema(found.schema).parquet(path).where("event_id >= 0"))


@check("stream_nearest", """
SELECT i.event_id, i.machine_id, i.ts, m.mes_ts, m.operator_id, m.units_produced, m.defective_units, m.production_time_min
FROM iot i LEFT JOIN best_mes m ON m.iot_id = i.event_id""", doubles="production_time_min")
def nearest_mes_on_stream(spark, folder):
    return _stream_nearest(spark, folder, fact.mes_feed, "mes")


@check("stream_nearest_scada", """
SELECT i.event_id, i.machine_id, i.ts, m.scada_ts, m.power_kw, m.machine_status, m.alarm_code
FROM iot i LEFT JOIN best_scada m ON m.iot_id = i.event_id""", doubles="power_kw")
def nearest_scada_on_stream(spark, folder):
    return _stream_nearest(spark, folder, fact.scada_feed, "scada")


STATE_SCHEMA = T.StructType([
    T.StructField("machine_id", T.StringType()), T.StructField("ts", T.TimestampType()),
    *[T.StructField(c, next(f.dataType for f in load.TOPIC_SCHEMA.fields if f.name == c)) for c in STATE_COLUMNS],
])


@check("stream_latest_state", "SELECT * FROM latest", doubles="temperature_c vibration_mm_s pressure_bar power_kw production_time_min")
def stream_latest_state(spark, folder):
    with few_state_partitions(spark):
        snapshots = runs.Snapshots(spark, fresh_path(spark, "state"), STATE_SCHEMA)
        runs.replay(kept.keep_latest_state(topic_stream(spark, folder), snapshots), spark, "state")
    return plain_time(snapshots.latest())


@check("stream_operators", "SELECT machine_id, operator_id, min(ts) AS first_seen, count(*) AS records FROM mes GROUP BY ALL")
def stream_operators(spark, folder):
    schema = T.StructType([
        T.StructField("machine_id", T.StringType()), T.StructField("operator_id", T.IntegerType()),
        T.StructField("first_seen", T.TimestampType()), T.StructField("records", T.LongType()),
    ])
    with few_state_partitions(spark):
        snapshots = runs.Snapshots(spark, fresh_path(spark, "operators"), schema)
        runs.replay(kept.keep_operators(feed_stream(spark, folder, "mes"), snapshots), spark, "operators")
    return plain_time(snapshots.latest())


@check("stream_affinity", "SELECT * FROM running", doubles="affinity")
def stream_affinity(spark, folder):
    schema = T.StructType([T.StructField("operator_id", T.IntegerType()), T.StructField("machine_id", T.StringType()), T.StructField("affinity", T.DoubleType())])
    snapshots = runs.Snapshots(spark, fresh_path(spark, "affinity"), schema)
    runs.replay(kept.keep_affinity(feed_stream(spark, folder, "mes"), snapshots), spark, "affinity")
    return snapshots.latest()


DAILY_SQL = "SELECT machine_id, CAST(ts AS DATE) AS day, CAST(sum(units_produced) AS BIGINT) AS units_produced FROM mes GROUP BY ALL"


def streamed_days(spark, folder):
    with few_state_partitions(spark):
        daily = load.daily_units(feed_stream(spark, folder, "mes", closed=True))
        path = fresh_path(spark, "daily")
        runs.replay(runs.to_table(daily, path), spark, "daily")
    return spark.read.schema(daily.schema).parquet(path)


@check("stream_units_daily", DAILY_SQL)
def stream_units_daily(spark, folder):
    return streamed_days(spark, folder)


@check("stream_units_weekly", "SELECT machine_id, strftime(ts, '%G-W%V') AS period, CAST(sum(units_produced) AS BIGINT) AS units_produced FROM mes GROUP BY ALL")
def stream_units_weekly(spark, folder):
    return load.roll_up(streamed_days(spark, folder), "week")


@check("stream_history", """
SELECT machine_id, ts, event_id, topic, temperature_c, vibration_mm_s, pressure_bar, power_kw, machine_status, alarm_code, operator_id, units_produced,
       defective_units, production_time_min, CAST(age AS INTEGER) AS age
FROM (SELECT *, row_number() OVER (PARTITION BY machine_id ORDER BY ts DESC, event_id DESC) AS age FROM events_long) WHERE age <= 48""",
       doubles="temperature_c vibration_mm_s pressure_bar power_kw production_time_min")
def stream_history(spark, folder):
    """The last 48 records of each machine, held in keyed state while the events arrive in three runs."""
    root = fresh_path(spark, "history")
    topics = events.by_topic(dict(zip(("iot", "scada", "mes"), feeds(spark, folder))))
    kinds = T.StructType([T.StructField(f.name, T.TimestampType()) if f.name == "ts" else f for f in topics.schema.fields])
    with few_state_partitions(spark):
        for part in range(3):
            chosen = topics.where(F.pmod(F.hash("ts"), F.lit(3)) == part)
            chosen.withColumn("ts", F.col("ts").cast("timestamp")).write.mode("append").parquet(f"{root}/inbox")
            runs.resume(history.keep_history(spark.readStream.schema(kinds).parquet(f"{root}/inbox")), root)
        return plain_time(history.read_history(spark, root))


SESSIONS_SQL = """
SELECT machine_id, min(ts) AS started, max(ts) AS ended, count(*) AS events
FROM (SELECT machine_id, ts, sum(CASE WHEN waited > 1800000000 THEN 1 ELSE 0 END) OVER (PARTITION BY machine_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS number
      FROM (SELECT machine_id, ts, event_id, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY machine_id ORDER BY ts, event_id)) AS waited FROM scada))
GROUP BY machine_id, number"""


@check("machine_sessions", SESSIONS_SQL)
def machine_sessions(spark, folder):
    """Runs of power readings without a pause of over half an hour."""
    return sessions.sessions(feed(spark, folder, "scada"))


@check("stream_sessions", SESSIONS_SQL)
def stream_sessions(spark, folder):
    with few_state_partitions(spark):
        found = sessions.stream_sessions(feed_stream(spark, folder, "scada", closed=True))
        path = fresh_path(spark, "sessions")
        runs.replay(runs.to_table(found, path), spark, "sessions")
    return plain_time(spark.read.schema(sessions.SESSION).parquet(path))


@check("stream_fact_load", "SELECT *, CAST(ts AS DATE) AS day FROM metrics", doubles="temperature_c vibration_mm_s pressure_bar production_time_min power_kw")
def stream_fact_load(spark, folder):
    """The whole load; the marker lets the newest rows settle."""
    loader = load.FactLoader(spark, fresh_path(spark, "staging"), fresh_path(spark, "fact"))
    runs.replay(loader.writer(topic_stream(spark, folder, closed=True)), spark, "load")
    iot, scada, mes = feeds(spark, folder)
    schema = T.StructType([
        T.StructField(f.name, T.TimestampType()) if f.name == "ts" else f
        for f in fact.enrich(fact.fuse(iot, mes, scada), *_seeds(spark)).schema.fields
    ])
    return plain_time(read_table(spark, loader.table, schema))


def _seeds(spark):
    from millrace.sources import dimensions

    return dimensions.seed(spark, "machine_status"), dimensions.seed(spark, "alarm_codes")


POWER_INPUTS = ["temperature_c", "vibration_mm_s", "pressure_bar"]
WEIGHTS = Weights((0.1, 0.2, 0.3), 0.5)


SCORED_SCHEMA = T.StructType([*STATE_SCHEMA.fields, T.StructField("trigger_ts", T.TimestampType())])


@check("stream_score", """
SELECT machine_id, ts, round(0.1::DOUBLE * temperature_c + 0.2::DOUBLE * vibration_mm_s + 0.3::DOUBLE * pressure_bar + 0.5::DOUBLE, 2) AS predicted FROM latest""")
def stream_score(spark, folder):
    """Scores of the latest state with fixed weights; one batch holds the whole replay."""
    schema = T.StructType([T.StructField("machine_id", T.StringType()), T.StructField("ts", T.TimestampType()), T.StructField("predicted", T.DoubleType())])
    with few_state_partitions(spark):
        state = runs.Snapshots(spark, fresh_path(spark, "state"), SCORED_SCHEMA)
        scores = runs.BatchFolders(spark, fresh_path(spark, "scores"), schema)
        writer = load.keep_scores(topic_stream(spark, folder), state, scores, POWER_INPUTS, WEIGHTS)
        runs.replay(writer, spark, "score")
    latest = scores.read().groupBy("machine_id").agg(F.max_by(F.struct("ts", "predicted"), "batch").alias("r")).select("machine_id", "r.*")
    return plain_time(latest)


@check("stream_upsert", """
SELECT date_trunc('hour', ts) AS ts, machine_id, arg_max(power_kw, event_id) AS power_kw, max(event_id) AS event_id,
       CAST(min(ts) AS DATE) AS day FROM scada GROUP BY date_trunc('hour', ts), machine_id""", doubles="power_kw")
def stream_upsert(spark, folder):
    rows = feed_stream(spark, folder, "scada").select(F.date_trunc("hour", "ts").alias("ts"), "machine_id", "power_kw", "event_id")
    path = fresh_path(spark, "upserted")
    runs.replay(load.keep_upserted(rows, path), spark, "upserted")
    return plain_time(read_table(spark, path, rows.schema))


@check("stream_first_per_key", "SELECT DISTINCT date_trunc('hour', ts) AS ts, machine_id FROM scada")
def stream_first_per_key(spark, folder):
    """One row per hour and machine survives."""
    rows = feed_stream(spark, folder, "scada").select(F.date_trunc("hour", "ts").alias("ts"), "machine_id", "event_id")
    with few_state_partitions(spark):
        path = fresh_path(spark, "first")
        runs.replay(runs.to_table(load.first_per_key(rows), path), spark, "first")
    return plain_time(spark.read.schema(rows.schema).parquet(path).select("ts", "machine_id"))


@check("stream_sgd", """
SELECT 0.1 * (1 - 1e-4 * 1e-3) - 1e-4 * avg(d * temperature_c) AS w_0, 0.2 * (1 - 1e-4 * 1e-3) - 1e-4 * avg(d * vibration_mm_s) AS w_1,
       0.3 * (1 - 1e-4 * 1e-3) - 1e-4 * avg(d * pressure_bar) AS w_2, 0.5 - 1e-4 * avg(d) AS b
FROM (SELECT *, 0.1 * temperature_c + 0.2 * vibration_mm_s + 0.3 * pressure_bar + 0.5 - (event_id % 50) AS d FROM iot)""", doubles="w_0 w_1 w_2 b")
def stream_sgd(spark, folder):
    """One gradient step per batch; the whole replay is one batch."""
    rows = feed_stream(spark, folder, "iot").withColumn("goal", (F.col("event_id") % 50).cast("double"))
    snapshots = runs.Snapshots(spark, fresh_path(spark, "weights"), load.weight_schema(3))
    runs.replay(load.keep_weights(rows, snapshots, POWER_INPUTS, "goal", WEIGHTS, 1e-4, 1e-3), spark, "sgd")
    return snapshots.latest()
