"""Checks of marts, aggregates, windows and the reports over all machines."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from millrace.checks import centres as centre_sql
from millrace.checks.registry import all_topics, check, feed, feeds, hourly
from millrace.checks.rows import ANCHOR, long_metrics, whole_fact
from millrace.operators import affinity, align, clustering, density, metrics, quantiles, scaling, state
from millrace.plans import anomalies, marts, performance
from millrace.session import written

# --- marts

PERIOD_SQL = {"day": "CAST(ts AS DATE)", "week": "strftime(ts, '%G-W%V')", "month": "strftime(ts, '%Y-%m')"}
MART_SQL = {
    "units": "SELECT machine_id, {p} AS period, CAST(sum(units_produced) AS BIGINT) AS units_produced FROM metrics GROUP BY ALL",
    "failures": """SELECT machine_id, {p} AS period, count(*) AS failure_count FROM metrics WHERE NOT ((machine_status = 'Idle' AND alarm_code = 'None')
        OR (machine_status = 'Running' AND alarm_code = 'None')) GROUP BY ALL""",
    "efficiency": """SELECT machine_id, {p} AS period, round(CAST(sum(units_produced - defective_units) AS DOUBLE)
        / NULLIF(sum(units_produced), 0) * 100, 2) AS efficiency_pct FROM metrics GROUP BY ALL""",
    "power": "SELECT machine_id, {p} AS period, round(sum(power_kw), 4) AS power_kw FROM metrics GROUP BY ALL",
    "plant_power": "SELECT {p} AS period, round(sum(power_kw), 4) AS power_kw FROM metrics GROUP BY ALL",
}


def _mart(report, grain, spark, folder):
    return marts.MARTS[report](whole_fact(spark, folder), grain)


for _report, _sql in MART_SQL.items():
    for _grain, _period in PERIOD_SQL.items():
        check(f"{_report}_{_grain}", _sql.format(p=_period), digits=4)(partial(_mart, _report, _grain))


ALL_MARTS_SQL = " UNION ALL ".join(
    f"SELECT '{report}' AS report, '{grain}' AS grain, {'NULL' if report == 'plant_power' else 'machine_id'} AS machine_id, CAST(period AS VARCHAR) AS period, "
    f"CAST({column} AS DOUBLE) AS value FROM ({MART_SQL[report].format(p=period)})"
    for report, column in marts.VALUE_OF.items() for grain, period in PERIOD_SQL.items())


@check("all_marts", ALL_MARTS_SQL, doubles="value", digits=2)
def all_marts(spark, folder):
    """All fifteen marts from one pass over the fact table."""
    sums, out = written(marts.daily_sums(whole_fact(spark, folder)), "sums"), None
    for report, value in marts.VALUE_OF.items():
        for grain in marts.GRAINS:
            rows = marts.from_daily(sums, report, grain)
            machine = F.col("machine_id") if "machine_id" in rows.columns else F.lit(None).cast("int")
            part = rows.select(
                F.lit(report).alias("report"), F.lit(grain).alias("grain"), machine.alias("machine_id"),
                F.col("period").cast("string").alias("period"), F.col(value).cast("double").alias("value"),
            )
            out = part if out is None else out.unionByName(part)
    return out


# --- aggregates


@check("affinity_batch", "SELECT * FROM affinity", doubles="affinity")
def affinity_batch(spark, folder):
    return affinity.from_totals(feed(spark, folder, "mes"))


@check("affinity_last", """
SELECT operator_id, machine_id, arg_max_null(rate, ts) AS affinity FROM
  (SELECT *, 1 - defective_units::DOUBLE / NULLIF(units_produced, 0) AS rate FROM mes)
GROUP BY ALL""", doubles="affinity")
def affinity_last(spark, folder):
    return affinity.from_last_row(feed(spark, folder, "mes"))


@check("affinity_running", "SELECT * FROM running", doubles="affinity")
def affinity_running(spark, folder):
    return affinity.running(feed(spark, folder, "mes"))


CENTRES = [[0.15, 1.0, 0.98], [0.5, 3.0, 0.97], [1.2, 8.0, 0.95]]
CENTRES_CTE = """
centres AS (SELECT * FROM (VALUES (0, 0.15::DOUBLE, 1.0::DOUBLE, 0.98::DOUBLE), (1, 0.5, 3.0, 0.97), (2, 1.2, 8.0, 0.95)) t(cluster, c0, c1, c2)),
perf AS (
  SELECT k.event_id, k.ts, k.machine_id, k.power_kw, k.time_per_unit, k.defect_pct, coalesce(a.affinity, 0.5) AS affinity
  FROM kpi k LEFT JOIN affinity a USING (operator_id, machine_id) WHERE units_produced > 0),
placed AS (
  SELECT p.*, cluster FROM perf p, centres c
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY (time_per_unit - c0) ** 2 + (defect_pct - c1) ** 2 + (affinity - c2) ** 2, cluster) = 1)"""


def performance_rows(spark, folder):
    """Hourly production rows with the three performance features."""
    iot, scada, mes = hourly(spark, folder)
    rows = align.kpi_rows(mes, scada, iot).join(mes.select("ts", "machine_id", "event_id"), ["ts", "machine_id"])
    known = written(affinity.from_totals(feed(spark, folder, "mes")), "affinity")
    return affinity.lookup(rows, known).na.drop(subset=performance.PERFORMANCE)


def placed_rows(spark, folder):
    return clustering.assign(performance_rows(spark, folder), performance.PERFORMANCE, CENTRES)


@check("assign_centres", "SELECT event_id, CAST(cluster AS INTEGER) AS cluster FROM placed", [CENTRES_CTE])
def assign_centres(spark, folder):
    return placed_rows(spark, folder).select("event_id", "cluster")


@check("lloyd_step", """
SELECT CAST(cluster AS INTEGER) AS cluster, count(*) AS n, avg(time_per_unit) AS time_per_unit, avg(defect_pct) AS defect_pct, avg(affinity) AS affinity
FROM placed GROUP BY 1""", [CENTRES_CTE], doubles="time_per_unit defect_pct affinity")
def lloyd_step(spark, folder):
    return clustering.update_centres(placed_rows(spark, folder), performance.PERFORMANCE)


@check("cluster_sizes", "SELECT CAST(cluster AS INTEGER) AS cluster, count(*) AS n FROM placed GROUP BY 1", [CENTRES_CTE])
def cluster_sizes(spark, folder):
    return metrics.cluster_sizes(placed_rows(spark, folder))


@check("cluster_power_quantiles", """
SELECT CAST(cluster AS INTEGER) AS cluster, count(power_kw) AS n, quantile_cont(power_kw, 0.1) AS p10, median(power_kw) AS p50, quantile_cont(power_kw, 0.9) AS p90
FROM placed GROUP BY 1""", [CENTRES_CTE], doubles="p10 p50 p90")
def cluster_power_quantiles(spark, folder):
    return quantiles.exact_quantiles(placed_rows(spark, folder), ["cluster"], "power_kw", {"p10": 0.1, "p50": 0.5, "p90": 0.9})


RECENT_CTE = """
recent AS (SELECT * FROM events_long QUALIFY row_number() OVER (PARTITION BY machine_id ORDER BY event_id DESC) <= 48),
readings AS (SELECT *, row_number() OVER (PARTITION BY machine_id ORDER BY event_id DESC) AS age FROM recent WHERE power_kw IS NOT NULL),
win AS (SELECT * FROM readings WHERE age <= 24),
centre AS (SELECT machine_id, median(power_kw) AS median_kw FROM win GROUP BY 1),
spread AS (SELECT machine_id, 1.4826::DOUBLE * median(abs(power_kw - median_kw)) AS mad_kw FROM win JOIN centre USING (machine_id) GROUP BY 1),
stats AS (
  SELECT machine_id, CAST(count(*) AS INTEGER) AS n, avg(power_kw) AS mean_kw, median(power_kw) AS median_kw, stddev_pop(power_kw) AS std_kw,
         min(power_kw) AS min_kw, max(power_kw) AS max_kw, arg_max(power_kw, event_id) AS current_kw FROM win GROUP BY 1),
span AS (SELECT machine_id, count(*) AS available, min(ts) AS window_start, max(ts) AS window_end FROM readings GROUP BY 1)"""


@check("last_n_power", "SELECT machine_id, ts, event_id, power_kw, age FROM win", [RECENT_CTE], doubles="power_kw")
def last_n_power(spark, folder):
    recent = state.last_n(all_topics(spark, folder), anomalies.RECORDS).where("power_kw is not null")
    return state.last_n(recent.drop("age"), anomalies.READINGS).select("machine_id", "ts", "event_id", "power_kw", F.col("age").cast("long"))


STATS = "n mean_kw median_kw std_kw min_kw max_kw".split()


@check("power_window_stats", f"SELECT machine_id, {', '.join(STATS)} FROM stats", [RECENT_CTE], doubles=" ".join(STATS[1:]))
def power_window_stats(spark, folder):
    return anomalies.window_stats(all_topics(spark, folder)).select("machine_id", *STATS)


@check("power_mad", "SELECT * FROM spread", [RECENT_CTE], doubles="mad_kw")
def power_mad(spark, folder):
    return anomalies.window_stats(all_topics(spark, folder)).select("machine_id", "mad_kw")


@check("energy_anomalies", """
SELECT machine_id, current_kw, window_start, window_end, (epoch_us(window_end) - epoch_us(window_start)) / 3.6e9::DOUBLE AS hours_covered,
       mean_kw, median_kw, std_kw, min_kw, max_kw, n AS data_points, score, score > 0.8 AS is_anomaly,
       CASE WHEN n < 10 THEN 'MAD' ELSE 'Z-score' END AS method, least(0.99, greatest(0.5, score * 1.2)) AS confidence,
       CASE WHEN score > 0.8 THEN 'high' ELSE 'low' END AS priority,
       CASE WHEN score > 0.8 THEN 'Immediate inspection recommended' ELSE 'Routine monitoring sufficient' END AS action,
       CASE WHEN n < 10 THEN 'Limited historical data' ELSE 'Power consumption ' || round(current_kw, 1) || 'kW vs expected range ['
         || round(mean_kw - 2 * std_kw, 1) || '-' || round(mean_kw + 2 * std_kw, 1) || ']kW' END AS trigger
FROM (SELECT s.*, p.*, least(1, greatest(0, 0.5 + abs(CASE
        WHEN n < 10 THEN CASE WHEN mad_kw > 0 THEN 0.6745 * (current_kw - median_kw) / mad_kw ELSE 0 END
        WHEN std_kw > 0 THEN (current_kw - mean_kw) / std_kw ELSE 0 END) / 3)) AS score
      FROM stats s JOIN spread USING (machine_id) JOIN span p USING (machine_id) WHERE available >= 5)""", [RECENT_CTE],
       doubles="current_kw hours_covered mean_kw median_kw std_kw min_kw max_kw score confidence")
def energy_anomalies(spark, folder):
    return anomalies.detect(all_topics(spark, folder))


SPARSE = """
sparse AS (SELECT * FROM events_long WHERE topic <> 'scada' OR replace(machine_id, 'Machine_', '')::INTEGER <= 7),
thin AS (SELECT * REPLACE (CASE WHEN machine_id = 'Machine_7' AND age > 3 THEN NULL ELSE power_kw END AS power_kw) FROM
  (SELECT *, row_number() OVER (PARTITION BY machine_id, power_kw IS NULL ORDER BY event_id DESC) AS age FROM sparse)),
thin_recent AS (SELECT * FROM thin QUALIFY row_number() OVER (PARTITION BY machine_id ORDER BY event_id DESC) <= 48),
thin_readings AS (SELECT *, row_number() OVER (PARTITION BY machine_id ORDER BY event_id DESC) AS back FROM thin_recent WHERE power_kw IS NOT NULL)"""


def sparse_topics(spark, folder):
    """All topics, but machines 8-10 report no power and machine 7 only its last three readings."""
    rows = all_topics(spark, folder)
    number = F.substring_index("machine_id", "_", -1).cast("int")
    rows = rows.where((F.col("topic") != "scada") | (number <= 7))
    known = rows.where("power_kw is not null and machine_id = 'Machine_7'")
    last = state.last_n(known, 3).select("event_id", F.lit(True).alias("keep"))
    kept = F.when((F.col("machine_id") == "Machine_7") & F.col("keep").isNull(), F.lit(None).cast("double")).otherwise(F.col("power_kw"))
    return rows.join(last, "event_id", "left").withColumn("power_kw", kept).drop("keep")


@check("anomaly_insufficient", """
SELECT m.machine_id, 'insufficient_data' AS status, CAST(count(r.event_id) AS INTEGER) AS available_readings, 10 AS required_readings,
       string_agg(strftime(r.ts, '%Y-%m-%d %H:%M:%S'), ',' ORDER BY r.ts) FILTER (r.back <= 3) AS last_data_points
FROM (SELECT DISTINCT machine_id FROM sparse) m LEFT JOIN thin_readings r USING (machine_id) GROUP BY 1 HAVING count(r.event_id) < 5""", [SPARSE])
def anomaly_insufficient(spark, folder):
    return anomalies.insufficient(sparse_topics(spark, folder))


@check("last3_ts", """
SELECT machine_id, string_agg(strftime(ts, '%Y-%m-%d %H:%M:%S'), ',' ORDER BY ts) AS last3 FROM readings WHERE age <= 3 GROUP BY 1""", [RECENT_CTE])
def last3_ts(spark, folder):
    arrays = state.recent_power(all_topics(spark, folder))
    stamps = F.transform(F.slice("all_readings", -3, 3), lambda r: F.date_format(r["ts"], "yyyy-MM-dd HH:mm:ss"))
    return arrays.select("machine_id", F.array_join(stamps, ",").alias("last3"))


@check("peak_ratio", """
SELECT machine_id, count(power_kw) AS records, max(power_kw) / avg(power_kw) AS peak_ratio FROM events_long GROUP BY 1""", doubles="peak_ratio")
def peak_ratio(spark, folder):
    return anomalies.peak_ratio(all_topics(spark, folder))


@check("peak_ratio_missing_as_zero", """
SELECT machine_id, count(*) AS records, max(coalesce(power_kw, 0)) / avg(coalesce(power_kw, 0)) AS peak_ratio FROM events_long GROUP BY 1""",
       doubles="peak_ratio")
def peak_ratio_missing_as_zero(spark, folder):
    return anomalies.peak_ratio(all_topics(spark, folder), missing_as_zero=True)


@check("latest_metric", """
SELECT 'iot_metrics' AS measurement, machine_id, 'vibration_mm_s' AS field, arg_max(vibration_mm_s, event_id) AS value, max(ts) AS ts FROM iot GROUP BY ALL
UNION ALL SELECT 'iot_metrics', machine_id, 'temperature_c', arg_max(temperature_c, event_id), max(ts) FROM iot GROUP BY ALL
UNION ALL SELECT 'iot_metrics', machine_id, 'pressure_bar', arg_max(pressure_bar, event_id), max(ts) FROM iot GROUP BY ALL
UNION ALL SELECT 'scada_metrics', machine_id, 'power_kw', arg_max(power_kw, event_id), max(ts) FROM scada GROUP BY ALL
UNION ALL SELECT 'mes_metrics', machine_id, 'operator_id', arg_max(operator_id, event_id), max(ts) FROM mes GROUP BY ALL
UNION ALL SELECT 'mes_metrics', machine_id, 'units_produced', arg_max(units_produced, event_id), max(ts) FROM mes GROUP BY ALL
UNION ALL SELECT 'mes_metrics', machine_id, 'defective_units', arg_max(defective_units, event_id), max(ts) FROM mes GROUP BY ALL
UNION ALL SELECT 'mes_metrics', machine_id, 'production_time_min', arg_max(production_time_min, event_id), max(ts) FROM mes GROUP BY ALL""",
       doubles="value")
def latest_metric(spark, folder):
    return state.latest_metric(long_metrics(spark, folder))


@check("operators_per_machine", "SELECT machine_id, operator_id, min(ts) AS first_seen, count(*) AS records FROM mes GROUP BY ALL")
def operators_per_machine(spark, folder):
    return affinity.operators_of(feed(spark, folder, "mes"))


@check("feed_volume", "SELECT topic, count(*) AS n, count(DISTINCT machine_id) AS machines, min(ts) AS first_ts, max(ts) AS last_ts FROM events_long GROUP BY 1")
def feed_volume(spark, folder):
    per_machine = all_topics(spark, folder).groupBy("topic", "machine_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )
    return per_machine.groupBy("topic").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("machines"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts")
    )


@check("latest_state", "SELECT * FROM latest", doubles="temperature_c vibration_mm_s pressure_bar power_kw production_time_min")
def latest_state(spark, folder):
    return state.latest_state(all_topics(spark, folder))


@check("energy_per_unit_asof", """
SELECT machine_id, ts, event_id, power_kw, units_asof, power_kw / NULLIF(units_asof, 0) AS energy_per_unit FROM (
  SELECT *, last_value(units_produced IGNORE NULLS) OVER (PARTITION BY machine_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS units_asof FROM events_long)
WHERE power_kw IS NOT NULL""", doubles="power_kw energy_per_unit")
def energy_per_unit_asof(spark, folder):
    return state.energy_per_unit_asof(all_topics(spark, folder))


@check("retrain_schedule", """
SELECT event_id, n, n % 50 = 0 AS retrain FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) AS n FROM events_long)""")
def retrain_schedule(spark, folder):
    """Every message numbered in time order; each fiftieth is due to retrain."""
    rows = all_topics(spark, folder).select("event_id", "ts")
    return metrics.numbered(rows, ["ts", "event_id"]).select("event_id", "n", (F.col("n") % 50 == 0).alias("retrain"))


@check("ts_folds", """
SELECT event_id, row_no, CAST(greatest(0, 5 - (total - row_no) // (total // 6)) AS INTEGER) AS fold FROM (
  SELECT event_id, row_number() OVER (ORDER BY ts, replace(machine_id, 'Machine_', 'Machine_')) AS row_no, count(*) OVER () AS total FROM mes_h)""")
def ts_folds(spark, folder):
    _, _, mes = hourly(spark, folder)
    return metrics.time_series_folds(mes.select("event_id", "ts", "machine_id")).select("event_id", "row_no", "fold")


@check("ffill_machine", "SELECT * FROM filled", doubles="power_kw temperature_c vibration_mm_s pressure_bar production_time_min")
def ffill_machine(spark, folder):
    iot, scada, mes = hourly(spark, folder)
    return align.forward_fill(align.outer(scada, iot, mes))


@check("latest_mes_metrics", """
SELECT machine_id, max(ts) AS ts, arg_max(operator_id, event_id) AS operator_id,
       arg_max_null(production_time_min / NULLIF(units_produced, 0), event_id) AS time_per_unit,
       arg_max_null(defective_units::DOUBLE / NULLIF(units_produced, 0) * 100, event_id) AS defect_pct FROM mes
GROUP BY 1""", doubles="time_per_unit defect_pct")
def latest_mes_metrics(spark, folder):
    mes = feed(spark, folder, "mes")
    return performance.performance_state(mes, affinity.from_totals(mes)).drop("affinity")


# --- rankings and reports

RANK_CTE = """
ranked AS (
  SELECT machine_id, operator_id, affinity, row_number() OVER (PARTITION BY machine_id ORDER BY affinity DESC, operator_id) AS rank,
         affinity >= 0.8 AS recommended FROM (SELECT DISTINCT machine_id, operator_id FROM mes) JOIN running USING (machine_id, operator_id))"""


@check("operator_ranking", "SELECT machine_id, operator_id, affinity, CAST(rank AS INTEGER) AS rank, recommended FROM ranked", [RANK_CTE], doubles="affinity")
def operator_ranking(spark, folder):
    return affinity.ranked(affinity.running(feed(spark, folder, "mes")))


@check("optimal_pairings", "SELECT machine_id, operator_id, affinity, CAST(rank AS INTEGER) AS rank, recommended FROM ranked", [RANK_CTE], doubles="affinity")
def optimal_pairings(spark, folder):
    mes = feed(spark, folder, "mes")
    return performance.optimal_pairings(mes, affinity.running(mes))


@check("top_operators", "SELECT machine_id, operator_id, affinity, CAST(rank AS INTEGER) AS rank, recommended FROM ranked WHERE rank <= 3", [RANK_CTE],
       doubles="affinity")
def top_operators(spark, folder):
    return affinity.ranked(affinity.running(feed(spark, folder, "mes")), top=3)


ENERGY_CTE = """
asof_units AS (
  SELECT machine_id, event_id, ts, power_kw, last_value(units_produced IGNORE NULLS) OVER (PARTITION BY machine_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS units
  FROM events_long),
last_energy AS (
  SELECT machine_id, power_kw / NULLIF(units, 0) AS energy_per_unit FROM asof_units WHERE power_kw IS NOT NULL AND power_kw / NULLIF(units, 0) IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY machine_id ORDER BY event_id DESC) = 1)"""


@check("energy_efficiency", """
SELECT machine_id, energy_per_unit, peak_ratio, 1 / energy_per_unit AS efficiency_score FROM last_energy
JOIN (SELECT machine_id, max(power_kw) / avg(power_kw) AS peak_ratio FROM scada GROUP BY 1) USING (machine_id)""", [ENERGY_CTE],
       doubles="energy_per_unit peak_ratio efficiency_score")
def energy_efficiency(spark, folder):
    return performance.energy_efficiency(all_topics(spark, folder))


STATE_CTE = """
last_mes AS (SELECT * FROM mes QUALIFY row_number() OVER (PARTITION BY machine_id ORDER BY event_id DESC) = 1),
perf_state AS (
  SELECT machine_id, operator_id, production_time_min / NULLIF(units_produced, 0) AS time_per_unit,
         defective_units::DOUBLE / NULLIF(units_produced, 0) * 100 AS defect_pct, coalesce(affinity, 0.5) AS affinity
  FROM last_mes LEFT JOIN running USING (operator_id, machine_id) WHERE units_produced > 0),
state_placed AS (
  SELECT s.*, c.* FROM perf_state s, centres c
  QUALIFY row_number() OVER (PARTITION BY machine_id ORDER BY (time_per_unit - c0) ** 2 + (defect_pct - c1) ** 2 + (affinity - c2) ** 2, cluster) = 1)"""


@check("performance_cluster", """
SELECT machine_id, CAST(cluster AS INTEGER) AS cluster, c0 AS centre_time_per_unit, c1 AS centre_defect_pct, c2 AS centre_affinity FROM state_placed""",
       [CENTRES_CTE, STATE_CTE], doubles="centre_time_per_unit centre_defect_pct centre_affinity")
def performance_cluster(spark, folder):
    mes = feed(spark, folder, "mes")
    return performance.performance_cluster(performance.performance_state(mes, affinity.running(mes)), CENTRES)


@check("performance_analysis", """
SELECT p.machine_id, CASE p.cluster WHEN 0 THEN 'high' WHEN 1 THEN 'average' ELSE 'low' END AS tier, time_per_unit, defect_pct, p.affinity,
       c0 AS centre_time_per_unit, c1 AS centre_defect_pct, t.top_operators, CASE p.cluster WHEN 1 THEN 'high' WHEN 2 THEN 'average' END AS target_tier,
       c0 - (SELECT b.c0 FROM centres b WHERE b.cluster = p.cluster - 1) AS time_gap, c1 - (SELECT b.c1 FROM centres b WHERE b.cluster = p.cluster - 1) AS defect_gap
FROM state_placed p LEFT JOIN (
  SELECT machine_id, string_agg(operator_id || ':' || round(affinity, 4), ',' ORDER BY rank) AS top_operators FROM ranked WHERE rank <= 3 GROUP BY 1) t
USING (machine_id)""", [CENTRES_CTE, STATE_CTE, RANK_CTE],
       doubles="time_per_unit defect_pct affinity centre_time_per_unit centre_defect_pct time_gap defect_gap")
def performance_analysis(spark, folder):
    mes = feed(spark, folder, "mes")
    return performance.performance_analysis(mes, affinity.running(mes), CENTRES)


@check("performance_trend", f"""
SELECT machine_id, operator_id, CAST(h AS INTEGER) AS hours_ahead, TIMESTAMP '{ANCHOR}' + to_hours(CAST(h AS INTEGER)) AS forecast_ts,
       CAST(hour(TIMESTAMP '{ANCHOR}' + to_hours(CAST(h AS INTEGER))) AS INTEGER) AS hour, CAST(cluster AS INTEGER) AS cluster,
       c0 AS predicted_time_per_unit, c1 AS predicted_defect_pct
FROM (SELECT s.machine_id, r.operator_id, c.* FROM running r JOIN perf_state s USING (machine_id), centres c
      QUALIFY row_number() OVER (PARTITION BY s.machine_id, r.operator_id
        ORDER BY (time_per_unit - c0) ** 2 + (defect_pct - c1) ** 2 + (r.affinity - c2) ** 2, cluster) = 1), range(1, 25) t(h)""",
       [CENTRES_CTE, STATE_CTE], doubles="predicted_time_per_unit predicted_defect_pct")
def performance_trend(spark, folder):
    mes = feed(spark, folder, "mes")
    return performance.performance_trend(mes, affinity.running(mes), CENTRES, ANCHOR)


HOUR_CENTRES = clustering.spread_centres(5, 3)
FORECAST_CTE = """
hist AS (SELECT machine_id, hour(ts)::DOUBLE AS hour, i.temperature_c, i.vibration_mm_s, s.power_kw FROM scada_h s JOIN iot_h i USING (ts, machine_id)),
sc AS (
  SELECT machine_id, avg(hour) AS mh, stddev_pop(hour) AS sh, avg(temperature_c) AS mt, stddev_pop(temperature_c) AS st,
         avg(vibration_mm_s) AS mv, stddev_pop(vibration_mm_s) AS sv, count(*) AS samples FROM hist GROUP BY 1 HAVING count(*) >= 10),
hour_centres AS (SELECT CAST(i AS INTEGER) AS cluster, -1.2::DOUBLE + 0.6::DOUBLE * i AS c FROM range(5) t(i)),
hist_placed AS (
  SELECT * FROM (SELECT row_number() OVER () AS id, machine_id, power_kw, (hour - mh) / sh AS x, (temperature_c - mt) / st AS y, (vibration_mm_s - mv) / sv AS z
                 FROM hist JOIN sc USING (machine_id)), hour_centres
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY (x - c) ** 2 + (y - c) ** 2 + (z - c) ** 2, cluster) = 1),
hour_stats AS (
  SELECT machine_id, cluster, median(power_kw) AS p50, quantile_cont(power_kw, 0.1) AS p10, quantile_cont(power_kw, 0.9) AS p90 FROM hist_placed GROUP BY ALL)"""


@check("energy_forecast", f"""
SELECT machine_id, hours_ahead, forecast_ts, cluster, samples, coalesce(p50, 0) AS predicted_kw, coalesce(p10, 0) AS lower_kw, coalesce(p90, 0) AS upper_kw
FROM (
  SELECT machine_id, CAST(h AS INTEGER) AS hours_ahead, TIMESTAMP '{ANCHOR}' + to_hours(CAST(h AS INTEGER)) AS forecast_ts, samples, cluster
  FROM latest JOIN sc USING (machine_id), range(1, 25) t(h), hour_centres
  QUALIFY row_number() OVER (PARTITION BY machine_id, h ORDER BY ((hour(TIMESTAMP '{ANCHOR}' + to_hours(CAST(h AS INTEGER))) - mh) / sh - c) ** 2
    + ((temperature_c - mt) / st - c) ** 2 + ((vibration_mm_s - mv) / sv - c) ** 2, cluster) = 1)
LEFT JOIN hour_stats USING (machine_id, cluster)""", [FORECAST_CTE], doubles="predicted_kw lower_kw upper_kw")
def energy_forecast(spark, folder):
    """With fixed centres; ``energy_forecast_fitted`` fits them per machine."""
    history = performance.hourly_history(align.inner(*hourly(spark, folder)[1::-1]))
    points = written(performance.scaled_history(history), "history")
    centres = written(points.select("machine_id").distinct().withColumn("centres", clustering.centre_array(HOUR_CENTRES)), "centres")
    latest = state.latest_state(all_topics(spark, folder), ("temperature_c", "vibration_mm_s"))
    return performance.energy_forecast(history, latest, centres, points, ANCHOR)


FITTED_CTE = [
    FORECAST_CTE,
    """points AS MATERIALIZED (
  SELECT machine_id, power_kw, [(hour - mh) / sh, (temperature_c - mt) / st, (vibration_mm_s - mv) / sv] AS x FROM hist JOIN sc USING (machine_id))""",
    *centre_sql.keyed("machine_fit", "points", HOUR_CENTRES),
    """machine_centres AS (SELECT machine_id, CAST(i - 1 AS INTEGER) AS cluster, centres[i] AS c FROM machine_fit, range(1, 6) t(i))""",
    """machine_stats AS (
  SELECT machine_id, cluster, median(power_kw) AS p50, quantile_cont(power_kw, 0.1) AS p10, quantile_cont(power_kw, 0.9) AS p90
  FROM (SELECT machine_id, power_kw, cluster FROM (SELECT *, row_number() OVER () AS id FROM points) JOIN machine_centres USING (machine_id)
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY (x[1] - c[1]) ** 2 + (x[2] - c[2]) ** 2 + (x[3] - c[3]) ** 2, cluster) = 1)
  GROUP BY ALL)""",
]


@check("energy_forecast_fitted", f"""
SELECT machine_id, hours_ahead, forecast_ts, cluster, samples, coalesce(p50, 0) AS predicted_kw, coalesce(p10, 0) AS lower_kw, coalesce(p90, 0) AS upper_kw
FROM (
  SELECT machine_id, CAST(h AS INTEGER) AS hours_ahead, TIMESTAMP '{ANCHOR}' + to_hours(CAST(h AS INTEGER)) AS forecast_ts, samples, cluster
  FROM latest JOIN sc USING (machine_id) JOIN machine_centres USING (machine_id), range(1, 25) t(h)
  QUALIFY row_number() OVER (PARTITION BY machine_id, h ORDER BY ((hour(TIMESTAMP '{ANCHOR}' + to_hours(CAST(h AS INTEGER))) - mh) / sh - c[1]) ** 2
    + ((temperature_c - mt) / st - c[2]) ** 2 + ((vibration_mm_s - mv) / sv - c[3]) ** 2, cluster) = 1)
LEFT JOIN machine_stats USING (machine_id, cluster)""", FITTED_CTE, doubles="predicted_kw lower_kw upper_kw", recursive=True)
def energy_forecast_fitted(spark, folder):
    history = performance.hourly_history(align.inner(*hourly(spark, folder)[1::-1]))
    points = written(performance.scaled_history(history), "history")
    centres = clustering.keyed_kmeans(points, "machine_id", "x", HOUR_CENTRES).select("machine_id", "centres")
    latest = state.latest_state(all_topics(spark, folder), ("temperature_c", "vibration_mm_s"))
    return performance.energy_forecast(history, latest, centres, points, ANCHOR)


# --- quality of predictions and clusters

PREDICTED = "power_kw + ((event_id % 41) - 20)::DOUBLE / 4.0"


def predictions(spark, folder):
    """Power rows with a deterministic made prediction, state guess and class scores."""
    scada = feed(spark, folder, "scada")
    guess = F.when(F.col("event_id") % 10 < 8, F.col("machine_status")).when(F.col("event_id") % 10 == 8, "Idle").otherwise("Running")
    rows = scada.withColumn("predicted", F.col("power_kw") + (F.col("event_id") % 41 - 20).cast("double") / F.lit(4.0)).withColumn("guess", guess)
    centres = {"Error": 103.0, "Idle": 111.0, "Running": 158.0}
    return rows.withColumns({f"score_{k}": F.round(1.0 / (1.0 + F.abs(F.col("predicted") - c)), 2) for k, c in centres.items()})


PREDICTION_CTE = f"""
predictions AS (
  SELECT *, round(1.0::DOUBLE / (1.0 + abs(predicted - 103.0)), 2) AS score_error, round(1.0::DOUBLE / (1.0 + abs(predicted - 111.0)), 2) AS score_idle,
         round(1.0::DOUBLE / (1.0 + abs(predicted - 158.0)), 2) AS score_running
  FROM (SELECT *, {PREDICTED} AS predicted, CASE WHEN event_id % 10 < 8 THEN machine_status WHEN event_id % 10 = 8 THEN 'Idle' ELSE 'Running' END AS guess FROM scada)),
scores AS (
  SELECT 'Error' AS class, score_error AS score, machine_status = 'Error' AS pos FROM predictions
  UNION ALL SELECT 'Idle', score_idle, machine_status = 'Idle' FROM predictions
  UNION ALL SELECT 'Running', score_running, machine_status = 'Running' FROM predictions),
aucs AS (
  SELECT class, (sum(r) FILTER (pos) - count(*) FILTER (pos) * (count(*) FILTER (pos) + 1) / 2.0) / (count(*) FILTER (pos) * count(*) FILTER (NOT pos)) AS auc
  FROM (SELECT *, rank() OVER w + (count(*) OVER (PARTITION BY class, score) - 1) / 2.0 AS r FROM scores WINDOW w AS (PARTITION BY class ORDER BY score))
  GROUP BY class)"""


@check("regression_metrics", """
SELECT count(*) AS n, avg(d * d) AS mse, avg(abs(d)) AS mae, sqrt(avg(d * d)) AS rmse, 1 - sum(d * d) / (var_pop(power_kw) * count(*)) AS r2,
       avg(d) AS error_mean, stddev_pop(d) AS error_std, min(d) AS error_min, max(d) AS error_max
FROM (SELECT *, predicted - power_kw AS d FROM predictions)""", [PREDICTION_CTE], doubles="mse mae rmse r2 error_mean error_std error_min error_max")
def regression_metrics(spark, folder):
    return metrics.regression(predictions(spark, folder), "power_kw", "predicted")


@check("classification_metrics", """
SELECT CAST(sum(support) AS BIGINT) AS n, sum(hits) / sum(support) AS accuracy, sum(p * support) / sum(support) AS precision, sum(r * support) / sum(support) AS recall,
       sum(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END * support) / sum(support) AS f1
FROM (SELECT t.class, support, hits, coalesce(hits / guessed, 0) AS p, hits / support AS r
      FROM (SELECT machine_status AS class, count(*)::DOUBLE AS support, (count(*) FILTER (guess = machine_status))::DOUBLE AS hits FROM predictions GROUP BY 1) t
      LEFT JOIN (SELECT guess AS class, count(*)::DOUBLE AS guessed FROM predictions GROUP BY 1) g USING (class))""", [PREDICTION_CTE],
       doubles="accuracy precision recall f1")
def classification_metrics(spark, folder):
    return metrics.classification(predictions(spark, folder), "machine_status", "guess")


CLASS_SCORES = {k: f"score_{k}" for k in ("Error", "Idle", "Running")}


@check("auc_ovr", "SELECT class, auc FROM aucs", [PREDICTION_CTE], doubles="auc")
def auc_ovr(spark, folder):
    return metrics.auc_one_vs_rest(predictions(spark, folder), "machine_status", CLASS_SCORES)


@check("auc_macro", "SELECT avg(auc) AS auc FROM aucs", [PREDICTION_CTE], doubles="auc")
def auc_macro(spark, folder):
    return metrics.macro_auc(predictions(spark, folder), "machine_status", CLASS_SCORES)


QUALITY_CTE = """
cc AS (SELECT cluster, count(*)::DOUBLE AS n, avg(time_per_unit) AS m0, avg(defect_pct) AS m1, avg(affinity) AS m2,
              var_pop(time_per_unit) + var_pop(defect_pct) + var_pop(affinity) AS v FROM placed GROUP BY 1),
allm AS (SELECT avg(time_per_unit) AS o0, avg(defect_pct) AS o1, avg(affinity) AS o2 FROM placed),
ch AS (SELECT count(*) AS clusters, (sum(n * ((m0 - o0) ** 2 + (m1 - o1) ** 2 + (m2 - o2) ** 2)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))) AS calinski_harabasz
       FROM cc, allm),
sp AS (SELECT cluster, m0, m1, m2, avg(sqrt((time_per_unit - m0) ** 2 + (defect_pct - m1) ** 2 + (affinity - m2) ** 2)) AS s FROM placed JOIN cc USING (cluster) GROUP BY ALL),
dbx AS (SELECT avg(w) AS davies_bouldin FROM (SELECT a.cluster, max((a.s + b.s) / sqrt((a.m0 - b.m0) ** 2 + (a.m1 - b.m1) ** 2 + (a.m2 - b.m2) ** 2)) AS w
       FROM sp a JOIN sp b ON a.cluster <> b.cluster GROUP BY 1)),
pair_sums AS (
  SELECT a.event_id, a.cluster, b.cluster AS other, count(*)::DOUBLE AS n,
         sum((a.time_per_unit - b.time_per_unit) ** 2 + (a.defect_pct - b.defect_pct) ** 2 + (a.affinity - b.affinity) ** 2) AS sq,
         sum(sqrt((a.time_per_unit - b.time_per_unit) ** 2 + (a.defect_pct - b.defect_pct) ** 2 + (a.affinity - b.affinity) ** 2)) AS eu
  FROM placed a, placed b GROUP BY ALL),
sil AS (
  SELECT event_id, max(sq / (n - 1)) FILTER (other = cluster) AS a_sq, min(sq / n) FILTER (other <> cluster) AS b_sq,
         max(eu / (n - 1)) FILTER (other = cluster) AS a_eu, min(eu / n) FILTER (other <> cluster) AS b_eu FROM pair_sums GROUP BY 1)"""


@check("cluster_ch_db", "SELECT clusters, calinski_harabasz, davies_bouldin FROM ch, dbx", [CENTRES_CTE, QUALITY_CTE],
       doubles="calinski_harabasz davies_bouldin", digits=4)
def cluster_ch_db(spark, folder):
    rows = placed_rows(spark, folder)
    spread = metrics.davies_bouldin(rows, performance.PERFORMANCE).select("davies_bouldin")
    return metrics.calinski_harabasz(rows, performance.PERFORMANCE).withColumn("davies_bouldin", spread.scalar())


@check("silhouette_squared", "SELECT avg((b_sq - a_sq) / greatest(a_sq, b_sq)) AS silhouette_squared FROM sil", [CENTRES_CTE, QUALITY_CTE],
       doubles="silhouette_squared")
def silhouette_squared(spark, folder):
    return metrics.silhouette_squared(placed_rows(spark, folder), performance.PERFORMANCE)


@check("silhouette", "SELECT avg((b_eu - a_eu) / greatest(a_eu, b_eu)) AS silhouette FROM sil", [CENTRES_CTE, QUALITY_CTE], doubles="silhouette")
def silhouette(spark, folder):
    return metrics.silhouette(written(placed_rows(spark, folder), "placed"), performance.PERFORMANCE)


@check("cluster_ellipse", """
SELECT CAST(cluster AS INTEGER) AS cluster, centre_x, centre_y, sqrt((vx + vy) / 2 + r) AS major, sqrt(greatest(0, (vx + vy) / 2 - r)) AS minor,
       degrees(atan2(2 * vxy, vx - vy) / 2) AS angle_deg
FROM (SELECT *, sqrt(((vx - vy) / 2) ** 2 + vxy ** 2) AS r FROM (
  SELECT cluster, avg(time_per_unit) AS centre_x, avg(defect_pct) AS centre_y, var_samp(time_per_unit) AS vx, var_samp(defect_pct) AS vy,
         covar_samp(time_per_unit, defect_pct) AS vxy FROM placed GROUP BY 1))""", [CENTRES_CTE], doubles="centre_x centre_y major minor angle_deg", digits=5)
def cluster_ellipse(spark, folder):
    return metrics.ellipse(placed_rows(spark, folder), "time_per_unit", "defect_pct")


@check("interpret_scores", """
SELECT event_id, CASE WHEN s > 0.7 THEN 'Strong cluster structure' WHEN s > 0.5 THEN 'Reasonable cluster structure' WHEN s > 0.25 THEN 'Weak cluster structure'
         ELSE 'No substantial cluster structure' END AS silhouette_text,
       CASE WHEN d < 0.5 THEN 'Excellent cluster separation' WHEN d < 1.0 THEN 'Good cluster separation' WHEN d < 1.5 THEN 'Moderate cluster separation'
         ELSE 'Poor cluster separation' END AS davies_bouldin_text,
       CASE WHEN r < 0.01 THEN 'Very low anomaly rate' WHEN r < 0.05 THEN 'Normal operating range' WHEN r < 0.1 THEN 'Elevated anomaly rate - investigate'
         ELSE 'High anomaly rate - immediate attention needed' END AS noise_text
FROM (SELECT event_id, (event_id % 101)::DOUBLE / 100 AS s, (event_id % 211)::DOUBLE / 100 AS d, (event_id % 151)::DOUBLE / 1000 AS r FROM iot)""")
def interpret_scores(spark, folder):
    rows = feed(spark, folder, "iot").select("event_id")

    def part(modulus, divisor):
        return (F.col("event_id") % modulus).cast("double") / F.lit(float(divisor))

    return rows.select(
        "event_id", metrics.interpret_silhouette(part(101, 100)).alias("silhouette_text"),
        metrics.interpret_davies_bouldin(part(211, 100)).alias("davies_bouldin_text"), metrics.interpret_noise(part(151, 1000)).alias("noise_text"),
    )


@check("cluster_health", """
SELECT event_id, score, CASE WHEN score > 0.8 THEN 'HEALTHY' WHEN score > 0.6 THEN 'STABLE' WHEN score > 0.4 THEN 'DEGRADED' ELSE 'CRITICAL' END AS grade
FROM (SELECT event_id, 0.4 * least(1, greatest(0, s / 0.7)) + 0.4 * least(1, greatest(0, (2 - d) / 2)) + 0.2 * least(1, greatest(0, 1 - r / 0.1)) AS score
  FROM (SELECT event_id, (event_id % 101)::DOUBLE / 100 AS s, (event_id % 211)::DOUBLE / 100 AS d, (event_id % 151)::DOUBLE / 1000 AS r FROM iot))""", doubles="score")
def cluster_health(spark, folder):
    def part(modulus, divisor):
        return (F.col("event_id") % modulus).cast("double") / F.lit(float(divisor))

    score = metrics.health_score(part(101, 100), part(211, 100), part(151, 1000))
    return feed(spark, folder, "iot").select("event_id", score.alias("score"), metrics.health_grade(score).alias("grade"))


DRIFT_CTE = """
quality AS (
  SELECT (SELECT avg((b_eu - a_eu) / greatest(a_eu, b_eu)) FROM sil) AS silhouette, (SELECT davies_bouldin FROM dbx) AS davies_bouldin),
early AS (SELECT * FROM placed WHERE ts < TIMESTAMP '2024-01-20 00:00:00'),
e_cc AS (SELECT cluster, avg(time_per_unit) AS m0, avg(defect_pct) AS m1, avg(affinity) AS m2 FROM early GROUP BY 1),
e_sp AS (SELECT cluster, m0, m1, m2, avg(sqrt((time_per_unit - m0) ** 2 + (defect_pct - m1) ** 2 + (affinity - m2) ** 2)) AS s FROM early JOIN e_cc USING (cluster) GROUP BY ALL),
e_db AS (SELECT avg(w) AS davies_bouldin FROM (SELECT a.cluster, max((a.s + b.s) / sqrt((a.m0 - b.m0) ** 2 + (a.m1 - b.m1) ** 2 + (a.m2 - b.m2) ** 2)) AS w
       FROM e_sp a JOIN e_sp b ON a.cluster <> b.cluster GROUP BY 1)),
e_pairs AS (
  SELECT a.event_id, a.cluster, b.cluster AS other, count(*)::DOUBLE AS n,
         sum(sqrt((a.time_per_unit - b.time_per_unit) ** 2 + (a.defect_pct - b.defect_pct) ** 2 + (a.affinity - b.affinity) ** 2)) AS eu
  FROM early a, early b GROUP BY ALL),
e_sil AS (SELECT event_id, max(eu / (n - 1)) FILTER (other = cluster) AS a_eu, min(eu / n) FILTER (other <> cluster) AS b_eu FROM e_pairs GROUP BY 1),
e_quality AS (SELECT (SELECT avg((b_eu - a_eu) / greatest(a_eu, b_eu)) FROM e_sil) AS silhouette, (SELECT davies_bouldin FROM e_db) AS davies_bouldin),
lines AS (
  SELECT 'Cluster Separation' AS metric, q.silhouette AS value, e.silhouette AS training_value,
         CASE WHEN q.silhouette > e.silhouette THEN 'improving' WHEN q.silhouette < e.silhouette THEN 'declining' ELSE 'stable' END AS trend,
         CASE WHEN q.silhouette > 0.7 THEN 'Strong cluster structure' WHEN q.silhouette > 0.5 THEN 'Reasonable cluster structure'
              WHEN q.silhouette > 0.25 THEN 'Weak cluster structure' ELSE 'No substantial cluster structure' END AS interpretation FROM quality q, e_quality e
  UNION ALL
  SELECT 'Cluster Compactness', q.davies_bouldin, e.davies_bouldin,
         CASE WHEN q.davies_bouldin < e.davies_bouldin THEN 'improving' WHEN q.davies_bouldin > e.davies_bouldin THEN 'declining' ELSE 'stable' END,
         CASE WHEN q.davies_bouldin < 0.5 THEN 'Excellent cluster separation' WHEN q.davies_bouldin < 1.0 THEN 'Good cluster separation'
              WHEN q.davies_bouldin < 1.5 THEN 'Moderate cluster separation' ELSE 'Poor cluster separation' END FROM quality q, e_quality e)"""


def both_qualities(spark, folder):
    """Quality of the fixed centres on the rows before 20 January (training) and on all rows."""
    rows = written(placed_rows(spark, folder), "placed")
    early = rows.where(F.col("ts") < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    return performance.cluster_quality(early, performance.PERFORMANCE), performance.cluster_quality(rows, performance.PERFORMANCE)


@check("metric_drift", "SELECT metric, value, training_value, abs(value - training_value) AS change, trend, interpretation FROM lines",
       [CENTRES_CTE, QUALITY_CTE, DRIFT_CTE], doubles="value training_value change")
def metric_drift(spark, folder):
    return performance.drift(*both_qualities(spark, folder))


@check("model_metrics", """
SELECT 'performance' AS model, metric, value, training_value, abs(value - training_value) AS change, trend, interpretation, health_score,
       CASE WHEN health_score > 0.8 THEN 'HEALTHY' WHEN health_score > 0.6 THEN 'STABLE' WHEN health_score > 0.4 THEN 'DEGRADED' ELSE 'CRITICAL' END AS health_status
FROM lines, (SELECT 0.4 * least(1, greatest(0, silhouette / 0.7)) + 0.4 * least(1, greatest(0, (2 - davies_bouldin) / 2)) AS health_score FROM quality)""",
       [CENTRES_CTE, QUALITY_CTE, DRIFT_CTE], doubles="value training_value change health_score")
def model_metrics(spark, folder):
    training, current = both_qualities(spark, folder)
    current = written(current, "quality")
    graded = performance.health(current)
    lines = performance.drift(written(training, "quality"), current).select(F.lit("performance").alias("model"), "*")
    return lines.select("*", *[graded.select(c).scalar().alias(c) for c in graded.columns])


# --- density clusters

ENERGY_FEATURES = performance.ENERGY
DENSITY_CTE = """
energy_rows AS (
  SELECT f.event_id, f.energy_per_unit, last_value(power_kw IGNORE NULLS) OVER w AS power_kw, last_value(temperature_c IGNORE NULLS) OVER w AS temperature_c,
         f.units_produced, f.machine_id, f.ts
  FROM kpi f WINDOW w AS (PARTITION BY machine_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
energy_full AS (
  SELECT event_id, power_kw / units_produced AS e, power_kw AS p, temperature_c AS t FROM energy_rows
  WHERE units_produced > 0 AND power_kw IS NOT NULL AND temperature_c IS NOT NULL),
es AS (SELECT avg(e) AS me, stddev_pop(e) AS se, avg(p) AS mp, stddev_pop(p) AS sp, avg(t) AS mt, stddev_pop(t) AS st FROM energy_full),
z AS MATERIALIZED (SELECT event_id, (e - me) / se AS x, (p - mp) / sp AS y, (t - mt) / st AS w FROM energy_full, es),
near AS MATERIALIZED (
  SELECT a.event_id AS a, b.event_id AS b FROM z a JOIN z b ON (a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.w - b.w) ** 2 <= 0.25::DOUBLE),
cores AS MATERIALIZED (SELECT a AS event_id FROM near GROUP BY a HAVING count(*) >= 5),
core_edges AS MATERIALIZED (SELECT a, b FROM near WHERE a IN (FROM cores) AND b IN (FROM cores))"""
LABEL_CTE = """
comp(node, label) USING KEY (node) AS (
  SELECT event_id, event_id FROM cores
  UNION
  SELECT e.b, min(c.label) FROM comp c JOIN core_edges e ON e.a = c.node JOIN recurring.comp old ON old.node = e.b
  WHERE c.label < old.label GROUP BY e.b),
labels AS (
  SELECT z.event_id, coalesce(c.label, (SELECT min(k.label) FROM near n JOIN comp k ON k.node = n.b WHERE n.a = z.event_id), -1) AS label
  FROM z LEFT JOIN comp c ON c.node = z.event_id)"""


def energy_points(spark, folder):
    """Hourly production rows with scaled energy features; power and temperature are carried forward."""
    iot, scada, mes = hourly(spark, folder)
    rows = align.forward_fill(align.left_of_mes(mes, scada, iot), ["power_kw", "temperature_c"])
    rows = rows.join(mes.select("ts", "machine_id", "event_id"), ["ts", "machine_id"])
    rows = rows.withColumn("energy_per_unit", F.try_divide("power_kw", F.col("units_produced").cast("double")))
    rows = written(rows.select("event_id", *ENERGY_FEATURES).na.drop(), "energy")
    return rows, scaling.Scaler.fit(rows, ENERGY_FEATURES)


def energy_clusters(spark, folder):
    rows, scaler = energy_points(spark, folder)
    return density.DensityClustering(scaler.transform(rows), ENERGY_FEATURES)


@check("dbscan_core", "SELECT event_id AS id, event_id IN (FROM cores) AS is_core FROM z", [DENSITY_CTE])
def dbscan_core(spark, folder):
    return energy_clusters(spark, folder).core_rows()


@check("dbscan_noise", """
SELECT event_id AS id, event_id NOT IN (SELECT a FROM near WHERE b IN (FROM cores)) AS is_noise FROM z""", [DENSITY_CTE])
def dbscan_noise(spark, folder):
    return energy_clusters(spark, folder).noise_rows()


@check("dbscan_labels", "SELECT event_id AS id, label FROM labels", [DENSITY_CTE, LABEL_CTE], recursive=True)
def dbscan_labels(spark, folder):
    return energy_clusters(spark, folder).labels()


@check("noise_share", "SELECT avg((event_id NOT IN (SELECT a FROM near WHERE b IN (FROM cores)))::INTEGER::DOUBLE) AS noise_share FROM z", [DENSITY_CTE], doubles="noise_share")
def noise_share(spark, folder):
    noise = energy_clusters(spark, folder).noise_rows()
    return metrics.noise_share(noise.select(F.when(F.col("is_noise"), -1).otherwise(0).alias("cluster")))


@check("energy_cluster", """
SELECT m.machine_id, energy_per_unit, power_kw, temperature_c,
       NOT EXISTS (SELECT 1 FROM cores JOIN z USING (event_id) WHERE (x - (energy_per_unit - me) / se) ** 2 + (y - (power_kw - mp) / sp) ** 2 + (w - (temperature_c - mt) / st) ** 2 <= 0.25)
         AS is_anomaly
FROM latest m JOIN last_energy USING (machine_id), es""", [ENERGY_CTE, DENSITY_CTE], doubles="energy_per_unit power_kw temperature_c")
def energy_cluster(spark, folder):
    """Each machine's latest point against the clusters of the history."""
    rows, scaler = energy_points(spark, folder)
    now = performance.energy_state(all_topics(spark, folder)).na.drop()
    model = density.DensityClustering(scaler.transform(rows), ENERGY_FEATURES)
    return performance.energy_cluster(now, scaler, model).drop("energy_cluster")


@check("model_metrics_energy")
def model_metrics_energy(spark, folder):
    """Energy clusters fitted on all rows against those fitted on the rows before 20 January."""
    rows, scaler = energy_points(spark, folder)
    early = feed(spark, folder, "mes").where(F.col("ts") < F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")).select("event_id")
    scaled = written(scaler.transform(rows), "scaled")
    qualities = []
    for part in (scaled.join(early, "event_id", "left_semi"), scaled):
        labels = density.DensityClustering(part, ENERGY_FEATURES).labels().withColumnRenamed("id", "event_id")
        labelled = part.join(labels, "event_id").select(*ENERGY_FEATURES, F.col("label").alias("cluster"))
        qualities.append(written(performance.cluster_quality(written(labelled, "labelled"), ENERGY_FEATURES), "quality"))
    graded = performance.health(qualities[1], energy=True)
    lines = performance.drift(*qualities, energy=True).select(F.lit("energy").alias("model"), "*")
    return lines.select("*", *[graded.select(c).scalar().alias(c) for c in graded.columns])
