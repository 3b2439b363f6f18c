"""Checks of the live path: offsets, the chain from messages to marts, fusion and online classification on streams."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.checks.registry import SQL, all_topics, check, feed, feeds
from millrace.checks.rows import whole_fact
from millrace.checks.streams import feed_stream, few_state_partitions, plain_time
from millrace.operators import align, fact, upsert
from millrace.operators.scaling import Scaler
from millrace.operators.scan import micros
from millrace.operators.upsert import read_table
from millrace.plans import jobs
from millrace.plans.changes import ChangeLog
from millrace.session import fresh_path, written
from millrace.sources import dimensions, messages, offsets
from millrace.streaming import live, runs
from millrace.streaming.classify import OnlineClassifier
from millrace.streaming.fusion import stream_matches

PARTITIONS = {"iot-data": 4, "scada-data": 2, "mes-data": 1}
CUTS = ["2024-01-08", "2024-01-16", "2024-01-23"]


def sent(spark, folder):
    """All feeds as messages in the log of a broker, in the order of their ids."""
    out = None
    for name, rows in zip(("iot", "scada", "mes"), feeds(spark, folder)):
        part = messages.publishable(rows.withColumn("sent_at", F.col("ts")), name, keep=("event_id", "sent_at"))
        out = part if out is None else out.unionByName(part)
    return messages.in_log(out, PARTITIONS, "event_id", F.floor(F.col("event_id") / 4096))


LOG_SQL = """
log AS (
  SELECT topic, 0 AS _, machine_id, event_id FROM (
    SELECT 'iot-data' AS topic, machine_id, event_id FROM iot UNION ALL SELECT 'scada-data', machine_id, event_id FROM scada
    UNION ALL SELECT 'mes-data', machine_id, event_id FROM mes)),
parted AS (
  SELECT topic, event_id, CASE topic WHEN 'iot-data' THEN {iot} WHEN 'scada-data' THEN {scada} ELSE 0 END AS partition FROM log),
records AS (
  SELECT topic, CAST(partition AS INTEGER) AS partition, row_number() OVER (PARTITION BY topic, partition ORDER BY event_id) - 1 AS "offset" FROM parted),
lossy AS (SELECT * FROM records WHERE "offset" % 17 NOT IN (3, 4) UNION ALL SELECT * FROM records WHERE "offset" % 23 = 5 AND "offset" % 17 NOT IN (3, 4))"""


def _parts(count: int) -> str:
    """The partition of each machine as a CASE: CRC-32 of its name, as the messages' key is dealt."""
    from zlib import crc32

    names = [f"Machine_{n}" for n in range(1, 11)]
    return "CASE machine_id " + " ".join(f"WHEN '{n}' THEN {crc32(n.encode()) % count}" for n in names) + " END"


LOG_SQL = LOG_SQL.format(iot=_parts(4), scada=_parts(2))


def lossy(spark, folder):
    """Of every 17 records two are lost; of every 23 one comes twice."""
    records, at = sent(spark, folder).select("topic", "partition", "offset"), F.col("offset")
    arrived = records.where(~(at % 17).isin(3, 4))
    return records, arrived.unionByName(arrived.where(at % 23 == 5))


@check("offset_gaps", """
SELECT topic, partition, before + 1 AS gap_from, "offset" - 1 AS gap_to, "offset" - before - 1 AS missing
FROM (SELECT *, lag("offset") OVER (PARTITION BY topic, partition ORDER BY "offset") AS before FROM (SELECT DISTINCT * FROM lossy))
WHERE "offset" - before > 1""", ctes=[LOG_SQL])
def offset_gaps(spark, folder):
    return offsets.gaps(lossy(spark, folder)[1])


@check("offset_ledger", """
SELECT topic, partition, min(l."offset") AS first_offset, max(l."offset") AS last_offset, count(*) AS records,
       count(*) - count(DISTINCT l."offset") AS repeated, max(l."offset") - min(l."offset") + 1 - count(DISTINCT l."offset") AS missing,
       any_value(e.last) - max(l."offset") AS lag
FROM lossy l JOIN (SELECT topic, partition, max("offset") AS last FROM records GROUP BY ALL) e USING (topic, partition) GROUP BY topic, partition""", ctes=[LOG_SQL])
def offset_ledger(spark, folder):
    records, arrived = lossy(spark, folder)
    ends = records.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end_offset"))
    return offsets.ledger(arrived, ends)


def spans(rows, ts="ts"):
    """``rows`` cut at ``CUTS``."""
    at = [F.lit(c).cast("timestamp_ntz") for c in CUTS]
    for low, high in zip([None, *at], [*at, None]):
        part = rows if low is None else rows.where(F.col(ts) >= low)
        yield part if high is None else part.where(F.col(ts) < high)


def _piped(spark, folder, marts=False):
    """Messages arrive in four parts; the path is started anew for each and goes on where it stopped."""
    root = fresh_path(spark, "live")
    log = written(sent(spark, folder), "log")  # numbered once, not for each part
    closing = [(t, 0, 1 << 40, '{"Timestamp":"2100-01-01 00:00:00","Machine_ID":"Machine_1"}') for t in PARTITIONS]
    parts = [*(p.select(*[f.name for f in messages.RECORD.fields]) for p in spans(log, "sent_at")), spark.createDataFrame(closing, messages.RECORD)]
    for part in parts:
        messages.write_record_files(part, f"{root}/inbox")
        records = messages.record_files(spark, f"{root}/inbox")
        live.run(records, f"{root}/state", f"{root}/fact", f"{root}/marts" if marts else None)
    return root


def to_seconds(sql: str) -> str:
    """Messages carry whole seconds and no null alarm; of copies of an instant the first arrived counts."""
    sql = sql.replace("SELECT event_id, ts, user_id", "SELECT event_id, date_trunc('second', ts) AS ts, user_id")
    sql = sql.replace("FROM ev WHERE event_type IN ('click', 'view'))", "FROM ev WHERE event_type IN ('click', 'view') QUALIFY row_number() OVER (PARTITION BY machine_id, ts ORDER BY event_id) = 1)")
    return sql.replace("WHEN k = 50 THEN NULL ELSE 'None'", "ELSE 'None'")


@check("stream_pipeline", "SELECT *, CAST(ts AS DATE) AS day FROM metrics", doubles="temperature_c vibration_mm_s pressure_bar production_time_min power_kw")
def stream_pipeline(spark, folder):
    with few_state_partitions(spark):
        root = _piped(spark, folder)
    iot, scada, mes = feeds(spark, folder)
    schema = T.StructType([
        T.StructField(f.name, T.TimestampType()) if f.name == "ts" else f
        for f in fact.enrich(fact.fuse(iot, mes, scada), *_seeds(spark)).schema.fields
    ])
    return plain_time(read_table(spark, f"{root}/fact", schema).where(F.col("ts") < "2100-01-01"))


def _seeds(spark):
    return dimensions.seed(spark, "machine_status"), dimensions.seed(spark, "alarm_codes")


@check("stream_pipeline_marts", """
SELECT machine_id, strftime(ts, '%G-W%V') AS period, CAST(sum(units_produced) AS BIGINT) AS units_produced FROM metrics GROUP BY ALL""")
def stream_pipeline_marts(spark, folder):
    """The weekly mart that the live path keeps, refreshed after each batch for the days that it touched."""
    with few_state_partitions(spark):
        root = _piped(spark, folder, marts=True)
    return spark.read.parquet(f"{root}/marts/units_week").select("machine_id", F.col("period").cast("string").alias("period"), "units_produced")


for _name in ("stream_pipeline", "stream_pipeline_marts"):
    SQL[_name] = to_seconds(SQL[_name])


CORRECTED = """
kept AS (
  SELECT CASE WHEN date_trunc('hour', ts) = ts OR extract('day' FROM ts) = 12 THEN units_produced + 1000 ELSE units_produced END AS units_produced, ts, machine_id
  FROM metrics WHERE CAST(ts AS DATE) <> DATE '2024-01-20')"""


@check("mart_refresh_from_log", """
SELECT machine_id, strftime(ts, '%G-W%V') AS period, CAST(sum(units_produced) AS BIGINT) AS units_produced FROM kept GROUP BY ALL""", ctes=[CORRECTED])
def mart_refresh_from_log(spark, folder):
    """Two loads, a correction of one day and the removal of another, each refreshed from the change log alone."""
    root = fresh_path(spark, "logged")
    table, log = f"{root}/fact", ChangeLog(spark, f"{root}/changes")
    rows = written(whole_fact(spark, folder), "fact")
    cut = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    refresh = partial(jobs.refresh_from_log, table, f"{root}/marts", log)
    for number, part in enumerate((rows.where(F.col("ts") < cut), rows.where(F.col("ts") >= cut))):
        log.write(upsert.insert_new(part, table, version=("temperature_c",)), f"load-{number}")
        refresh()
    changed = rows.where((F.dayofmonth("ts") == 12) | (micros("ts") % 3_600_000_000 == 0))
    changed = changed.withColumn("units_produced", F.col("units_produced") + 1000)
    present = read_table(spark, table, rows.schema).join(changed.select("ts", "machine_id"), ["ts", "machine_id"], "left_anti")
    days = changed.select(F.to_date("ts").alias("day")).distinct()
    merged = written(present.join(days, "day", "left_semi").select(*rows.columns, "day").unionByName(changed.withColumn("day", F.to_date("ts"))), "corrected")
    upsert._replace_days(merged, table)
    log.write(upsert.days_of(merged), "correction")
    upsert.remove(spark, f"{table}/day=2024-01-20")
    log.write([_date("2024-01-20")], "removal")
    refresh()
    return spark.read.parquet(f"{root}/marts/units_week").select("machine_id", F.col("period").cast("string").alias("period"), "units_produced")


def _date(text):
    import datetime as dt

    return dt.date.fromisoformat(text)


@check("stream_fuse", """
SELECT f.* REPLACE (s.alarm_code AS alarm_code) FROM fused f LEFT JOIN best_scada s ON s.iot_id = f.event_id""",
       doubles="temperature_c vibration_mm_s pressure_bar production_time_min power_kw")
def stream_fuse(spark, folder):
    """Both matches of every sensor row from one join, unmatched rows included."""
    with few_state_partitions(spark):
        iot, mes, scada = (feed_stream(spark, folder, name, closed=True) for name in ("iot", "mes", "scada"))
        found = stream_matches(iot, [fact.mes_feed(mes), fact.scada_feed(scada)], ["temperature_c", "vibration_mm_s", "pressure_bar"])
        path = fresh_path(spark, "fused")
        runs.replay(runs.to_table(found, path), spark, "fuse")
    return plain_time(spark.read.schema(found.schema).parquet(path).where("event_id >= 0"))


# Centres and spreads of the inputs, as the feeds are declared.
CENTRES = {"machine_code": (4.5, 3.0), "power_kw": (150.0, 30.0), "temperature_c": (70.0, 6.0), "vibration_mm_s": (1.5, 0.7), "pressure_bar": (5.2, 1.3)}
CLASSES = {"machine_status": ["Error", "Idle", "Running"], "alarm_code": ["Low Pressure", "None", "Overheat", "Vibration High"]}
ETA, ALPHA = 0.1, 1e-4


def _events_sql(label):
    order = "PARTITION BY machine_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    last = ", ".join(f"last_value({c} IGNORE NULLS) OVER w AS {c}" for c in ("power_kw", "temperature_c", "vibration_mm_s", "pressure_bar", "machine_status"))
    scaled = ", ".join(f"({c} - {m!r}::DOUBLE) / {s!r}::DOUBLE AS x_{i}" for i, (c, (m, s)) in enumerate(CENTRES.items()))
    batch = " + ".join(f"(ts >= TIMESTAMP '{c}')::INTEGER" for c in CUTS)
    return f"""
known AS (
  SELECT topic, event_id, ts, machine_id, {last}, last_value(CASE WHEN alarm_code = '' THEN 'None' ELSE alarm_code END IGNORE NULLS) OVER w AS alarm_code
  FROM events_long WINDOW w AS ({order})),
ready AS (
  SELECT event_id, machine_id, ts, {label} AS actual, {batch} AS batch, {scaled}
  FROM (SELECT *, (SELECT count(*) FROM machines WHERE machine_name < k.machine_id)::DOUBLE AS machine_code FROM known k)
  WHERE topic IN ('iot', 'scada') AND power_kw IS NOT NULL AND temperature_c IS NOT NULL),
w_0 AS (SELECT unnest([{', '.join(f"'{c}'" for c in CLASSES[label])}]) AS class, {', '.join(f'0.0::DOUBLE AS w_{i}' for i in range(5))}, 0.0::DOUBLE AS b)"""


def _step_sql(k):
    dot = " + ".join(f"w_{i} * x_{i}" for i in range(5)) + " + b"
    moved = ", ".join(f"any_value(w_{i}) * (1 - {ETA * ALPHA!r}::DOUBLE) - {ETA!r}::DOUBLE * avg(e * x_{i}) AS w_{i}" for i in range(5))
    return f"""
w_{k + 1} AS (
  SELECT class, {moved}, any_value(b) - {ETA!r}::DOUBLE * avg(e) AS b
  FROM (SELECT *, 1 / (1 + exp(-({dot}))) - (actual = class)::INTEGER AS e FROM ready, w_{k} WHERE batch = {k} AND actual IS NOT NULL) GROUP BY class)"""


def _chosen_sql(k):
    dot = " + ".join(f"w_{i} * x_{i}" for i in range(5)) + " + b"
    return (
        f"SELECT event_id, machine_id, ts, class AS predicted, actual FROM ready, w_{k} WHERE batch = {k} "
        f"QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY 1 / (1 + exp(-({dot}))) DESC, class) = 1"
    )


def _learned(spark, folder, label):
    """Events arrive in four parts; the stream is started anew for each."""
    root = fresh_path(spark, "classes")
    seeds = [dimensions.seed(spark, name) for name in ("machines", "machine_status", "alarm_codes")]
    scaler = Scaler({c: m for c, (m, _) in CENTRES.items()}, {c: s for c, (_, s) in CENTRES.items()})
    model = OnlineClassifier(spark, f"{root}/model", label, CLASSES[label], align.dimension_codes(*seeds), scaler, ETA, ALPHA)
    topics = all_topics(spark, folder)
    kinds = T.StructType([T.StructField(f.name, T.TimestampType()) if f.name == "ts" else f for f in topics.schema.fields])
    for part in spans(topics):
        part.withColumn("ts", F.col("ts").cast("timestamp")).write.mode("append").parquet(f"{root}/inbox")
        runs.resume(model.writer(spark.readStream.schema(kinds).parquet(f"{root}/inbox")), f"{root}/model")
    return model


@check("stream_sgd_logloss", "SELECT * FROM w_4", ctes=[_events_sql("machine_status"), *map(_step_sql, range(4))], doubles="w_0 w_1 w_2 w_3 w_4 b")
def stream_sgd_logloss(spark, folder):
    """Weights of the state classes after four batches, one step each."""
    with few_state_partitions(spark):
        return _learned(spark, folder, "machine_status").weights.latest()


def _stream_classify(label, spark, folder):
    """The class of every event by the weights before its batch."""
    with few_state_partitions(spark):
        found = _learned(spark, folder, label).predictions.read().drop("day", "batch")
    return plain_time(found)


for _label, _name in (("machine_status", "stream_classify"), ("alarm_code", "stream_classify_alarm")):
    check(_name, " UNION ALL ".join(f"SELECT * FROM ({_chosen_sql(k)})" for k in range(4)), ctes=[_events_sql(_label), *map(_step_sql, range(3))])(
        partial(_stream_classify, _label)
    )
