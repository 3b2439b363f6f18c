"""Checks of sources, sinks, projections, filters, joins and scalar functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace import schemas
from millrace.checks.registry import all_topics, check, feed, feeds, hourly
from millrace.functions import clean, kpis
from millrace.operators import affinity, align, asof, fact, state, upsert
from millrace.plans import marts, performance
from millrace.session import fresh_path, written
from millrace.sources import dimensions, events, files, messages, metrics, tables

ANCHOR = "2024-01-31 00:00:00"


def whole_fact(spark, folder):
    iot, scada, mes = feeds(spark, folder)
    return fact.enrich(fact.fuse(iot, mes, scada), dimensions.seed(spark, "machine_status"), dimensions.seed(spark, "alarm_codes"))


# --- sources and sinks


@check("src_csv_feed", """
SELECT date_trunc('second', ts) AS ts, machine_id, power_kw, machine_status, alarm_code FROM scada""", doubles="power_kw")
def src_csv_feed(spark, folder):
    path = fresh_path(spark, "scada-csv")
    files.write_feed_csv(feed(spark, folder, "scada"), path, "scada")
    rows = files.read_feed_csv(spark, path, "scada")
    return rows.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@check("src_dimensions", """
SELECT 'machines' AS dimension, machine_no AS id, machine_name AS name, (SELECT count(*) FROM iot WHERE iot.machine_id = machine_name) AS uses FROM machines
UNION ALL SELECT 'machine_status', status_id, status_name, (SELECT count(*) FROM scada WHERE machine_status = status_name) FROM machine_status_dim
UNION ALL SELECT 'alarm_codes', alarm_id, alarm_name, (SELECT count(*) FROM scada WHERE alarm_code = alarm_name) FROM alarm_codes
UNION ALL SELECT 'operators', operator_no, NULL, (SELECT count(*) FROM mes WHERE operator_id = operator_no) FROM operators""")
def src_dimensions(spark, folder):
    """Each dimension written and read back, with the number of feed rows that use each entry."""
    iot, scada, mes = feeds(spark, folder)
    uses = {
        "machines": (iot, "machine_id", "machine_name"), "machine_status": (scada, "machine_status", "status_name"),
        "alarm_codes": (scada, "alarm_code", "alarm_name"), "operators": (mes, "operator_id", "operator_no"),
    }
    out = None
    for name, (rows, used, key) in uses.items():
        path = fresh_path(spark, name)
        dimensions.copy(dimensions.seed(spark, name), path)
        table = spark.read.parquet(path)
        counted = rows.groupBy(F.col(used).alias(key)).agg(F.count(F.lit(1)).alias("n"))
        label = F.lit(None).cast("string") if name == "operators" else F.col(key)
        part = table.join(counted, key, "left").select(
            F.lit(name).alias("dimension"), F.col(dimensions.DIMENSIONS[name][0].split()[0]).alias("id"), label.alias("name"),
            F.coalesce("n", F.lit(0)).alias("uses"),
        )
        out = part if out is None else out.unionByName(part)
    return out


@check("src_json_events", """
SELECT 'scada-data' AS topic, date_trunc('second', ts) AS ts, machine_id, power_kw, machine_status,
       CASE WHEN alarm_code IS NULL OR alarm_code = '' THEN 'None' ELSE alarm_code END AS alarm_code, false AS is_rejected
FROM scada""", doubles="power_kw")
def src_json_events(spark, folder):
    """Published messages read back; publishing sends a missing alarm as ''."""
    sent = messages.publishable(feed(spark, folder, "scada"), "scada").select("topic", "value")
    return messages.parse(sent, "scada").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@check("src_topic_union", """
SELECT topic, machine_id, count(*) AS n, count(power_kw) AS with_power, count(units_produced) AS with_units,
       sum(temperature_c) AS temperature_sum FROM events_long GROUP BY topic, machine_id""", doubles="temperature_sum", digits=2)
def src_topic_union(spark, folder):
    return all_topics(spark, folder).groupBy("topic", "machine_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("power_kw").alias("with_power"), F.count("units_produced").alias("with_units"),
        F.sum("temperature_c").alias("temperature_sum"),
    )


BOUNDS = tables.time_bounds("2024-01-01 00:00:00", "2024-01-31 00:00:00", 8)


@check("src_table_partitioned", """
SELECT least(7, greatest(0, CAST(floor(epoch(ts - TIMESTAMP '2024-01-01') / 324000) AS INTEGER))) AS part, count(*) AS n,
       min(ts) AS first_ts, max(ts) AS last_ts FROM iot GROUP BY 1""")
def src_table_partitioned(spark, folder):
    """The ranges a partitioned table read uses, each read by its own predicate."""
    iot = feed(spark, folder, "iot")
    out = None
    for i, predicate in enumerate(tables.range_predicates("ts", BOUNDS)):
        part = iot.where(predicate).withColumn("part", F.lit(i))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@check("table_to_fact", "SELECT * FROM metrics", doubles="temperature_c vibration_mm_s pressure_bar production_time_min power_kw")
def table_to_fact(spark, folder):
    """Staging tables with times as text, read by ranges of equal counts, to the fact table."""
    staged = {}
    for name, rows in zip(("iot", "scada", "mes"), feeds(spark, folder)):
        kind = rows.schema["ts"].dataType
        stored = written(rows.withColumn("ts", F.date_format("ts", tables.TEXT_TIME)), name)
        bounds = tables.balanced_bounds(stored.select("ts"), 8)
        parts = [stored.where(p) for p in tables.range_predicates("ts", bounds)]
        whole = tables.parsed_time(reduce(DataFrame.unionByName, parts), "ts").where("NOT is_rejected").drop("is_rejected")
        staged[name] = written(whole.withColumn("ts", F.col("ts").cast(kind)), f"{name}-read")
    seeds = [dimensions.seed(spark, name) for name in ("machine_status", "alarm_codes")]
    return fact.enrich(fact.fuse(staged["iot"], staged["mes"], staged["scada"]), *seeds)


@check("sink_fact_roundtrip", "SELECT *, CAST(ts AS DATE) AS day FROM metrics",
       doubles="temperature_c vibration_mm_s pressure_bar production_time_min power_kw")
def sink_fact_roundtrip(spark, folder):
    rows = whole_fact(spark, folder)
    path = fresh_path(spark, "fact")
    files.write_by_day(rows, path)
    return files.read_by_day(spark, path, rows.schema)


@check("sink_json_messages", """
SELECT 'mes-data' AS topic, machine_id AS key,
       '{"Timestamp":"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '","Machine_ID":"' || machine_id || '","Operator_ID":' || operator_id ||
       ',"Units_Produced":' || units_produced || ',"Defective_Units":' || defective_units || ',"Production_Time_min":' ||
       CAST(production_time_min AS VARCHAR) || '}' AS value FROM mes""")
def sink_json_messages(spark, folder):
    return messages.publishable(feed(spark, folder, "mes"), "mes")


@check("sink_long_metrics", """
SELECT measurement, field, machine_id, count(*) AS n, sum(value) AS total, max(ts) AS last_ts FROM (
  SELECT 'iot_metrics' AS measurement, 'temperature_c' AS field, machine_id, ts, temperature_c AS value FROM iot
  UNION ALL SELECT 'iot_metrics', 'vibration_mm_s', machine_id, ts, vibration_mm_s FROM iot
  UNION ALL SELECT 'iot_metrics', 'pressure_bar', machine_id, ts, pressure_bar FROM iot
  UNION ALL SELECT 'scada_metrics', 'power_kw', machine_id, ts, power_kw FROM scada
  UNION ALL SELECT 'mes_metrics', 'operator_id', machine_id, ts, operator_id FROM mes
  UNION ALL SELECT 'mes_metrics', 'units_produced', machine_id, ts, units_produced FROM mes
  UNION ALL SELECT 'mes_metrics', 'defective_units', machine_id, ts, defective_units FROM mes
  UNION ALL SELECT 'mes_metrics', 'production_time_min', machine_id, ts, production_time_min FROM mes)
GROUP BY ALL""", doubles="total", digits=2)
def sink_long_metrics(spark, folder):
    long = long_metrics(spark, folder)
    path = fresh_path(spark, "metrics")
    metrics.write_long(long, path)
    back = spark.read.schema(long.schema).parquet(path)
    return back.groupBy("measurement", "field", "machine_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.max("ts").alias("last_ts")
    )


def long_metrics(spark, folder):
    iot, scada, mes = feeds(spark, folder)
    return metrics.to_long({"iot": iot, "scada": scada, "mes": mes})


@check("mart_refresh_incremental", "SELECT machine_id, CAST(ts AS DATE) AS day, CAST(sum(units_produced) AS BIGINT) AS units_produced FROM metrics GROUP BY ALL")
def mart_refresh_incremental(spark, folder):
    """A daily mart built from an early load, then refreshed for the days the second load touches."""
    rows = written(whole_fact(spark, folder), "fact")
    cut = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    path = fresh_path(spark, "mart")

    def daily(fact_rows):
        return marts.units(fact_rows, "day")

    early, late = rows.where(F.col("ts") < cut), rows.where(F.col("ts") >= cut)
    upsert.refresh_days(early, early.select(F.to_date("ts").alias("day")), daily, path)
    upsert.refresh_days(rows, late.select(F.to_date("ts").alias("day")), daily, path)
    return spark.read.parquet(path).select("machine_id", "day", "units_produced")


# --- projections and filters


@check("fact_project", "SELECT ts, machine_id, temperature_c AS temp_c, units_produced AS units, power_kw AS kw, alarm_code FROM fused",
       doubles="temp_c kw")
def fact_project(spark, folder):
    iot, scada, mes = feeds(spark, folder)
    return fact.fuse(iot, mes, scada).select(
        "ts", "machine_id", F.col("temperature_c").alias("temp_c"), F.col("units_produced").alias("units"),
        F.col("power_kw").alias("kw"), "alarm_code",
    )


@check("norm_alarm", "SELECT event_id, CASE WHEN alarm_code = '' THEN 'None' ELSE alarm_code END AS alarm_code FROM scada")
def norm_alarm(spark, folder):
    return feed(spark, folder, "scada").select("event_id", clean.norm_alarm("alarm_code").alias("alarm_code"))


@check("denorm_alarm", "SELECT event_id, CASE WHEN alarm_code IS NULL OR alarm_code = 'None' THEN '' ELSE alarm_code END AS alarm_code FROM scada")
def denorm_alarm(spark, folder):
    return feed(spark, folder, "scada").select("event_id", clean.denorm_alarm("alarm_code").alias("alarm_code"))


@check("failure_rows", """
SELECT event_id, machine_status, alarm_code FROM scada
WHERE NOT ((machine_status = 'Idle' AND alarm_code = 'None') OR (machine_status = 'Running' AND alarm_code = 'None'))""")
def failure_rows(spark, folder):
    return feed(spark, folder, "scada").where(clean.is_failure()).select("event_id", "machine_status", "alarm_code")


@check("gate_required", "SELECT * FROM fused WHERE power_kw IS NOT NULL AND units_produced IS NOT NULL AND alarm_code IS NOT NULL",
       doubles="temperature_c vibration_mm_s pressure_bar production_time_min power_kw")
def gate_required(spark, folder):
    iot, scada, mes = feeds(spark, folder)
    return fact.fuse(iot, mes, scada).where(clean.has_all(["power_kw", "units_produced", "alarm_code"]))


@check("missing_fields", """
SELECT event_id, concat_ws(',', CASE WHEN power_kw IS NULL THEN 'power_kw' END, CASE WHEN units_produced IS NULL THEN 'units_produced' END,
       CASE WHEN alarm_code IS NULL THEN 'alarm_code' END) AS missing FROM fused""")
def missing_fields(spark, folder):
    iot, scada, mes = feeds(spark, folder)
    names = clean.missing_fields(["power_kw", "units_produced", "alarm_code"])
    return fact.fuse(iot, mes, scada).select("event_id", F.array_join(names, ",").alias("missing"))


@check("drop_keyless", "SELECT event_id, machine_id FROM iot WHERE event_id % 7 <> 0 AND event_id % 11 <> 0")
def drop_keyless(spark, folder):
    """Every seventh row loses its machine, every eleventh names an empty one."""
    event = F.col("event_id")
    name = F.when(event % 7 == 0, F.lit(None)).when(event % 11 == 0, "").otherwise(F.col("machine_id"))
    rows = feed(spark, folder, "iot").withColumn("machine_id", name)
    return clean.with_key(rows).select("event_id", "machine_id")


@check("slice_machine", "SELECT * FROM scada WHERE machine_id = 'Machine_3'", doubles="power_kw")
def slice_machine(spark, folder):
    return feed(spark, folder, "scada").where(F.col("machine_id") == "Machine_3")


@check("min_samples", """
SELECT s.machine_id, count(*) AS samples, CASE WHEN count(*) < 150 THEN 'insufficient_samples' ELSE 'ok' END AS status
FROM scada_h s JOIN iot_h i USING (ts, machine_id) GROUP BY 1""")
def min_samples(spark, folder):
    iot, scada, _ = hourly(spark, folder)
    counted = align.inner(scada, iot).groupBy("machine_id").agg(F.count(F.lit(1)).alias("samples"))
    return counted.withColumn("status", F.when(F.col("samples") < 150, "insufficient_samples").otherwise("ok"))


@check("metric_range_filter", "SELECT machine_id, ts, vibration_mm_s AS value FROM iot WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'", doubles="value")
def metric_range_filter(spark, folder):
    found = metrics.in_range(long_metrics(spark, folder), "iot_metrics", "vibration_mm_s", "2024-01-10 00:00:00")
    return found.select("machine_id", "ts", "value")


@check("gauge_level", """
SELECT machine_id, arg_max(vibration_mm_s, event_id) AS value, CASE WHEN arg_max(vibration_mm_s, event_id) >= 1 THEN 'red' ELSE 'green' END AS level
FROM iot GROUP BY 1""", doubles="value")
def gauge_level(spark, folder):
    latest = state.latest_metric(metrics.to_long({"iot": feed(spark, folder, "iot")}))
    latest = latest.where("field = 'vibration_mm_s'")
    return latest.select("machine_id", "value", clean.gauge_level("value", 1.0).alias("level"))


@check("reject_corrupt", """
SELECT machine_id, count(*) FILTER (event_id % 13 <> 0) AS kept, count(*) FILTER (event_id % 13 = 0) AS rejected,
       sum(power_kw) FILTER (event_id % 13 <> 0) AS power_kw FROM scada GROUP BY 1""", doubles="power_kw", digits=2)
def reject_corrupt(spark, folder):
    """Power as text; every thirteenth value is damaged."""
    text = F.when(F.col("event_id") % 13 == 0, "n/a").otherwise(F.col("power_kw").cast("string"))
    rows = clean.split_numeric(feed(spark, folder, "scada").withColumn("power_kw", text), ["power_kw"])
    return rows.groupBy("machine_id").agg(
        F.count(F.when(~F.col("is_corrupt"), 1)).alias("kept"), F.count(F.when(F.col("is_corrupt"), 1)).alias("rejected"),
        F.sum("power_kw").alias("power_kw"),
    )


# --- joins


@check("nearest_mes", """
SELECT i.event_id, i.machine_id, i.ts, m.mes_ts, m.operator_id, m.units_produced, m.defective_units, m.production_time_min
FROM iot i LEFT JOIN best_mes m ON m.iot_id = i.event_id""", doubles="production_time_min")
def nearest_mes(spark, folder):
    iot, _, mes = feeds(spark, folder)
    return asof.nearest_within(iot.select("event_id", "machine_id", "ts"), [fact.mes_feed(mes)], ["machine_id"], matched_at=True)


@check("nearest_scada", """
SELECT i.event_id, i.machine_id, i.ts, m.scada_ts, m.power_kw, m.machine_status, m.alarm_code
FROM iot i LEFT JOIN best_scada m ON m.iot_id = i.event_id""", doubles="power_kw")
def nearest_scada(spark, folder):
    iot, scada, _ = feeds(spark, folder)
    return asof.nearest_within(iot.select("event_id", "machine_id", "ts"), [fact.scada_feed(scada)], ["machine_id"], matched_at=True)


@check("nearest_rank", """
SELECT i.event_id, i.machine_id, i.ts, m.mes_ts, m.operator_id, m.units_produced, m.defective_units, m.production_time_min
FROM iot i JOIN best_mes m ON m.iot_id = i.event_id""", doubles="production_time_min")
def nearest_rank(spark, folder):
    iot, _, mes = feeds(spark, folder)
    return asof.nearest_by_rank(iot, fact.mes_feed(mes), ["machine_id"], "event_id")


@check("fuse_streams", "SELECT * FROM fused", doubles="temperature_c vibration_mm_s pressure_bar production_time_min power_kw")
def fuse_streams(spark, folder):
    iot, scada, mes = feeds(spark, folder)
    return fact.fuse(iot, mes, scada)


@check("fuse_require_mes", "SELECT * FROM fused WHERE operator_id IS NOT NULL",
       doubles="temperature_c vibration_mm_s pressure_bar production_time_min power_kw")
def fuse_require_mes(spark, folder):
    iot, scada, mes = feeds(spark, folder)
    return fact.fuse(iot, mes, scada, require_mes=True)


@check("enrich_fact", "SELECT * FROM metrics", doubles="temperature_c vibration_mm_s pressure_bar production_time_min power_kw")
def enrich_fact(spark, folder):
    return whole_fact(spark, folder)


@check("resolve_iot", """
SELECT ts, temperature_c, vibration_mm_s, pressure_bar, machine_no FROM iot JOIN machines ON machine_id = machine_name""",
       doubles="temperature_c vibration_mm_s pressure_bar")
def resolve_iot(spark, folder):
    return fact.resolve_iot(feed(spark, folder, "iot"), dimensions.seed(spark, "machines"))


@check("resolve_mes", """
SELECT ts, operator_no, units_produced, defective_units, production_time_min, machine_no
FROM mes JOIN operators ON operator_id = operator_no JOIN machines ON machine_id = machine_name WHERE event_id % 5 <> 0""",
       doubles="production_time_min")
def resolve_mes(spark, folder):
    """The operator comes as text; every fifth text is no number."""
    text = F.when(F.col("event_id") % 5 == 0, "unknown").otherwise(F.col("operator_id").cast("string"))
    rows = feed(spark, folder, "mes").withColumn("operator_id", text)
    return fact.resolve_mes(rows, dimensions.seed(spark, "machines"), dimensions.seed(spark, "operators"))


@check("resolve_scada", """
SELECT ts, power_kw, machine_no, alarm_id, status_id FROM scada JOIN machines ON machine_id = machine_name
JOIN alarm_codes ON alarm_code = alarm_name JOIN machine_status_dim ON machine_status = status_name""", doubles="power_kw")
def resolve_scada(spark, folder):
    seeds = [dimensions.seed(spark, n) for n in ("machines", "machine_status", "alarm_codes")]
    return fact.resolve_scada(feed(spark, folder, "scada"), *seeds)


@check("insert_new_only", "SELECT event_id, ts, machine_id FROM iot WHERE event_id % 3 <> 0")
def insert_new_only(spark, folder):
    iot = feed(spark, folder, "iot").select("event_id", "ts", "machine_id")
    return fact.only_new(iot, iot.where("event_id % 3 = 0"))


ALIGNED = "power_kw temperature_c vibration_mm_s pressure_bar"


@check("align_outer2", """
SELECT ts, machine_id, power_kw, machine_status, alarm_code, temperature_c, vibration_mm_s, pressure_bar
FROM (SELECT ts, machine_id, power_kw, machine_status, alarm_code FROM scada_h)
FULL JOIN (SELECT ts, machine_id, temperature_c, vibration_mm_s, pressure_bar FROM iot_h) USING (ts, machine_id)""", doubles=ALIGNED)
def align_outer2(spark, folder):
    iot, scada, _ = hourly(spark, folder)
    return align.outer(scada, iot)


@check("align_outer3", "SELECT * FROM aligned", doubles=ALIGNED + " production_time_min")
def align_outer3(spark, folder):
    iot, scada, mes = hourly(spark, folder)
    return align.outer(scada, iot, mes)


@check("align_left_mes", """
SELECT ts, machine_id, operator_id, units_produced, defective_units, production_time_min, power_kw, machine_status, alarm_code,
       temperature_c, vibration_mm_s, pressure_bar FROM kpi""", doubles=ALIGNED + " production_time_min")
def align_left_mes(spark, folder):
    iot, scada, mes = hourly(spark, folder)
    return align.left_of_mes(mes, scada, iot)


@check("align_inner", """
SELECT ts, machine_id, s.power_kw, s.machine_status, s.alarm_code, i.temperature_c, i.vibration_mm_s, i.pressure_bar
FROM scada_h s JOIN iot_h i USING (ts, machine_id)""", doubles=ALIGNED)
def align_inner(spark, folder):
    iot, scada, _ = hourly(spark, folder)
    return align.inner(scada, iot)


@check("affinity_lookup", """
SELECT m.event_id, m.operator_id, m.machine_id, coalesce(a.affinity, 0.5) AS affinity FROM mes m
LEFT JOIN (SELECT * FROM affinity WHERE operator_id <> 1003) a USING (operator_id, machine_id)""", doubles="affinity")
def affinity_lookup(spark, folder):
    """Operator 1003 is left out of the table, so its rows take the default."""
    mes = feed(spark, folder, "mes")
    known = written(affinity.from_totals(mes).where("operator_id <> 1003"), "affinity")
    return affinity.lookup(mes.select("event_id", "operator_id", "machine_id"), known)


# --- scalar functions


@check("fn_periods", """
SELECT event_id, CAST(ts AS DATE) AS day, date_trunc('week', ts)::DATE AS week_start, strftime(ts, '%G-W%V') AS iso_week,
       strftime(ts, '%Y-%m') AS month FROM iot""")
def fn_periods(spark, folder):
    return feed(spark, folder, "iot").select(
        "event_id", clean.period("ts", "day").alias("day"), F.to_date(F.date_trunc("week", "ts")).alias("week_start"),
        clean.period("ts", "week").alias("iso_week"), clean.period("ts", "month").alias("month"),
    )


@check("fn_time_diff", """
SELECT iot_id AS event_id, CAST(trunc((epoch_us(mes_ts) - epoch_us(i.ts)) / 1000000) AS BIGINT) AS seconds_to_mes,
       CAST(floor(epoch_us(i.ts) / 1000000) AS BIGINT) AS epoch_s FROM best_mes JOIN iot i ON i.event_id = iot_id""")
def fn_time_diff(spark, folder):
    iot, _, mes = feeds(spark, folder)
    near = asof.nearest_within(iot.select("event_id", "machine_id", "ts"), [fact.mes_feed(mes)], ["machine_id"], required=["mes"], matched_at=True)
    return near.select(
        "event_id", F.timestamp_diff("SECOND", F.col("ts"), F.col("mes_ts")).alias("seconds_to_mes"),
        F.unix_timestamp(F.col("ts").cast("timestamp")).alias("epoch_s"),
    )


@check("fn_parse_ts", "SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN date_trunc('second', ts) END AS ts FROM iot")
def fn_parse_ts(spark, folder):
    """Times as text; every ninth text is no time."""
    text = F.when(F.col("event_id") % 9 == 0, "not a time").otherwise(clean.format_ts("ts"))
    return feed(spark, folder, "iot").select("event_id", clean.parse_ts(text).cast("timestamp_ntz").alias("ts"))


@check("fn_format_ts", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS text FROM iot")
def fn_format_ts(spark, folder):
    return feed(spark, folder, "iot").select("event_id", clean.format_ts("ts").alias("text"))


@check("fn_machine_no", """
SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN CAST(replace(machine_id, 'Machine_', '') AS INTEGER) END AS machine_no FROM iot""")
def fn_machine_no(spark, folder):
    name = F.when(F.col("event_id") % 10 == 0, "Machine").otherwise(F.col("machine_id"))
    return feed(spark, folder, "iot").select("event_id", clean.machine_no(name).alias("machine_no"))


@check("fn_math", """
SELECT event_id, abs(temperature_c - 70) AS off, round(vibration_mm_s, 1) AS rounded, NULLIF(event_id % 5, 0) AS non_zero,
       least(1, greatest(0, pressure_bar - 4)) AS clipped FROM iot""", doubles="off rounded clipped")
def fn_math(spark, folder):
    return feed(spark, folder, "iot").select(
        "event_id", F.abs(F.col("temperature_c") - 70).alias("off"), F.round("vibration_mm_s", 1).alias("rounded"),
        F.nullif(F.col("event_id") % 5, F.lit(0)).alias("non_zero"), clean.clip(F.col("pressure_bar") - 4, 0.0, 1.0).alias("clipped"),
    )


@check("fn_hour", "SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n FROM iot GROUP BY 1")
def fn_hour(spark, folder):
    return feed(spark, folder, "iot").groupBy(F.hour("ts").alias("hour")).agg(F.count(F.lit(1)).alias("n"))


@check("derive_kpis", "SELECT ts, machine_id, time_per_unit, defect_rate, defect_pct, energy_per_unit FROM kpi",
       doubles="time_per_unit defect_rate defect_pct energy_per_unit")
def derive_kpis(spark, folder):
    iot, scada, mes = hourly(spark, folder)
    return align.kpi_rows(mes, scada, iot).select("ts", "machine_id", "time_per_unit", "defect_rate", "defect_pct", "energy_per_unit")


@check("derive_features", """
SELECT ts, machine_id, units_produced / NULLIF(production_time_min, 0) AS throughput, defect_rate,
       power_kw * (production_time_min / 60.0::DOUBLE) / NULLIF(units_produced, 0) AS energy_efficiency FROM kpi""",
       doubles="throughput defect_rate energy_efficiency")
def derive_features(spark, folder):
    iot, scada, mes = hourly(spark, folder)
    rows = align.with_ratios(align.left_of_mes(mes, scada, iot))
    return rows.select("ts", "machine_id", "throughput", "defect_rate", "energy_efficiency")


@check("flatten_snapshot", "SELECT ts, machine_id, power_kw, machine_status, coalesce(alarm_code, '') AS alarm_code FROM scada_h",
       doubles="power_kw")
def flatten_snapshot(spark, folder):
    """Hourly rows as nested snapshots of all machines, then flattened again."""
    _, scada, _ = hourly(spark, folder)
    rows = messages.flatten_snapshot(messages.snapshots(scada, "scada"), "scada")
    return rows.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@check("future_hours", f"""
SELECT machine_id, CAST(h AS INTEGER) AS hours_ahead, TIMESTAMP '{ANCHOR}' + to_hours(CAST(h AS INTEGER)) AS forecast_ts,
       CAST(hour(TIMESTAMP '{ANCHOR}' + to_hours(CAST(h AS INTEGER))) AS INTEGER) AS hour
FROM (SELECT DISTINCT machine_id FROM iot), range(1, 25) t(h)""")
def future_hours(spark, folder):
    return performance.future_hours(feed(spark, folder, "iot").select("machine_id").distinct(), ANCHOR, 24)


@check("head_by_time", "SELECT event_id, ts, machine_id FROM iot ORDER BY ts, machine_id LIMIT 144")
def head_by_time(spark, folder):
    """The first 144 rows in time order."""
    return feed(spark, folder, "iot").select("event_id", "ts", "machine_id").orderBy("ts", "machine_id").limit(144)


@check("upsert_last_wins", """
SELECT date_trunc('hour', ts) AS ts, machine_id, arg_max(power_kw, event_id) AS power_kw, max(event_id) AS event_id,
       CAST(min(ts) AS DATE) AS day FROM scada GROUP BY date_trunc('hour', ts), machine_id""", doubles="power_kw")
def upsert_last_wins(spark, folder):
    """Hourly keys written in two loads (even ids first), the second load twice."""
    rows = feed(spark, folder, "scada").select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), "machine_id", "power_kw", "event_id")
    path = fresh_path(spark, "latest")
    upsert.upsert(rows.where("event_id % 2 = 0"), path)
    for _ in range(2):
        upsert.upsert(rows.where("event_id % 2 = 1"), path)
    return upsert.read_table(spark, path, rows.schema)


@check("insert_first_wins", """
SELECT date_trunc('hour', ts) AS ts, machine_id, arg_min(power_kw, event_id) AS power_kw, min(event_id) AS event_id,
       CAST(min(ts) AS DATE) AS day FROM scada GROUP BY date_trunc('hour', ts), machine_id""", doubles="power_kw")
def insert_first_wins(spark, folder):
    """The same keys, first write wins; loads in time order, the second twice."""
    rows = feed(spark, folder, "scada").select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), "machine_id", "power_kw", "event_id")
    path = fresh_path(spark, "first")
    cut = F.lit("2024-01-15 12:30:00").cast("timestamp_ntz")
    upsert.insert_new(rows.where(F.col("ts") < cut), path)
    for _ in range(2):
        upsert.insert_new(rows.where(F.col("ts") >= cut), path)
    return upsert.read_table(spark, path, rows.schema)
