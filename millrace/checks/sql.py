"""SQL views the check queries start from; they mirror ``millrace.sources.events``."""

VIEWS = """
ev AS (
  SELECT event_id, ts, user_id, event_type, 'Machine_' || (user_id % 10 + 1) AS machine_id,
         CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k
  FROM events),
iot AS (
  SELECT event_id, ts, machine_id,
         60.0::DOUBLE + ((event_id * 7919) % 2001)::DOUBLE / 100.0::DOUBLE AS temperature_c,
         0.4::DOUBLE + ((event_id * 104729) % 231)::DOUBLE / 100.0::DOUBLE AS vibration_mm_s,
         3.0::DOUBLE + ((event_id * 1299709) % 451)::DOUBLE / 100.0::DOUBLE AS pressure_bar
  FROM ev WHERE event_type IN ('click', 'view')),
scada AS (
  SELECT event_id, ts, machine_id,
         100.0::DOUBLE + k::DOUBLE + (event_id % 100)::DOUBLE / 100.0::DOUBLE AS power_kw,
         CASE WHEN k < 6 THEN 'Error' WHEN k < 16 THEN 'Idle' ELSE 'Running' END AS machine_status,
         CASE WHEN k < 6 THEN CASE event_id % 3 WHEN 0 THEN 'Low Pressure' WHEN 1 THEN 'Overheat' ELSE 'Vibration High' END
              WHEN k < 16 THEN '' WHEN k >= 94 THEN 'Low Pressure' WHEN k >= 91 THEN 'Overheat'
              WHEN k >= 89 THEN 'Vibration High' WHEN k = 50 THEN NULL ELSE 'None' END AS alarm_code
  FROM ev WHERE event_type IN ('error', 'signup')),
mes AS (
  SELECT event_id, ts, machine_id, CAST(1000 + (user_id // 10) % 10 AS INTEGER) AS operator_id,
         CAST(CASE WHEN event_id % 97 = 0 THEN 0 ELSE 50 + event_id % 451 END AS INTEGER) AS units_produced,
         CAST(event_id % 10 AS INTEGER) AS defective_units, (10 + event_id % 111)::DOUBLE AS production_time_min
  FROM ev WHERE event_type = 'purchase'),
iot_h AS (
  SELECT * REPLACE (date_trunc('hour', ts) AS ts) FROM iot
  QUALIFY row_number() OVER (PARTITION BY machine_id, date_trunc('hour', iot.ts) ORDER BY iot.ts DESC, event_id DESC) = 1),
scada_h AS (
  SELECT * REPLACE (date_trunc('hour', ts) AS ts) FROM scada
  QUALIFY row_number() OVER (PARTITION BY machine_id, date_trunc('hour', scada.ts) ORDER BY scada.ts DESC, event_id DESC) = 1),
mes_h AS (
  SELECT * REPLACE (date_trunc('hour', ts) AS ts) FROM mes
  QUALIFY row_number() OVER (PARTITION BY machine_id, date_trunc('hour', mes.ts) ORDER BY mes.ts DESC, event_id DESC) = 1),
machines AS (SELECT CAST(n AS INTEGER) AS machine_no, 'Machine_' || n AS machine_name FROM range(1, 11) t(n)),
machine_status_dim AS (SELECT * FROM (VALUES (1, 'Running'), (2, 'Idle'), (3, 'Error')) t(status_id, status_name)),
alarm_codes AS (
  SELECT * FROM (VALUES (1, 'None'), (2, 'Low Pressure'), (3, 'Overheat'), (4, 'Vibration High')) t(alarm_id, alarm_name)),
operators AS (SELECT CAST(n AS INTEGER) AS operator_no FROM range(1000, 1010) t(n)),
best_mes AS (
  SELECT i.event_id AS iot_id, m.ts AS mes_ts, m.operator_id, m.units_produced, m.defective_units, m.production_time_min
  FROM iot i JOIN mes m ON i.machine_id = m.machine_id AND m.ts BETWEEN i.ts - INTERVAL 3600 SECOND AND i.ts + INTERVAL 3600 SECOND
  QUALIFY row_number() OVER (PARTITION BY i.event_id ORDER BY abs(epoch_us(i.ts) - epoch_us(m.ts)), m.ts, m.event_id) = 1),
best_scada AS (
  SELECT i.event_id AS iot_id, s.ts AS scada_ts, s.power_kw, s.machine_status, s.alarm_code
  FROM iot i JOIN scada s ON i.machine_id = s.machine_id AND s.ts BETWEEN i.ts - INTERVAL 900 SECOND AND i.ts + INTERVAL 900 SECOND
  QUALIFY row_number() OVER (PARTITION BY i.event_id ORDER BY abs(epoch_us(i.ts) - epoch_us(s.ts)), s.ts, s.event_id) = 1),
fused AS (
  SELECT i.*, m.operator_id, m.units_produced, m.defective_units, m.production_time_min, s.power_kw, s.machine_status,
         CASE WHEN s.alarm_code = '' THEN 'None' ELSE s.alarm_code END AS alarm_code
  FROM iot i LEFT JOIN best_mes m ON m.iot_id = i.event_id LEFT JOIN best_scada s ON s.iot_id = i.event_id),
metrics AS (
  SELECT f.ts, CAST(replace(f.machine_id, 'Machine_', '') AS INTEGER) AS machine_id, f.temperature_c, f.vibration_mm_s,
         f.pressure_bar, CAST(f.operator_id AS VARCHAR) AS operator_id, f.units_produced, f.defective_units,
         f.production_time_min, f.power_kw, d.status_id AS machine_status_id, d.status_name AS machine_status,
         a.alarm_id, f.alarm_code
  FROM fused f LEFT JOIN machine_status_dim d ON f.machine_status = d.status_name
  LEFT JOIN alarm_codes a ON f.alarm_code = a.alarm_name),
events_long AS (
  SELECT 'iot' AS topic, event_id, ts, machine_id, temperature_c, vibration_mm_s, pressure_bar, NULL::DOUBLE AS power_kw,
         NULL::VARCHAR AS machine_status, NULL::VARCHAR AS alarm_code, NULL::INTEGER AS operator_id,
         NULL::INTEGER AS units_produced, NULL::INTEGER AS defective_units, NULL::DOUBLE AS production_time_min FROM iot
  UNION ALL SELECT 'scada', event_id, ts, machine_id, NULL, NULL, NULL, power_kw, machine_status, alarm_code, NULL, NULL, NULL, NULL FROM scada
  UNION ALL SELECT 'mes', event_id, ts, machine_id, NULL, NULL, NULL, NULL, NULL, NULL, operator_id, units_produced, defective_units, production_time_min FROM mes),
aligned AS (
  SELECT ts, machine_id, power_kw, machine_status, alarm_code, temperature_c, vibration_mm_s, pressure_bar, operator_id,
         units_produced, defective_units, production_time_min
  FROM (SELECT ts, machine_id, power_kw, machine_status, alarm_code FROM scada_h)
  FULL JOIN (SELECT ts, machine_id, temperature_c, vibration_mm_s, pressure_bar FROM iot_h) USING (ts, machine_id)
  FULL JOIN (SELECT ts, machine_id, operator_id, units_produced, defective_units, production_time_min FROM mes_h) USING (ts, machine_id)),
filled AS (
  SELECT ts, machine_id, last_value(power_kw IGNORE NULLS) OVER w AS power_kw,
         last_value(machine_status IGNORE NULLS) OVER w AS machine_status, last_value(alarm_code IGNORE NULLS) OVER w AS alarm_code,
         last_value(temperature_c IGNORE NULLS) OVER w AS temperature_c, last_value(vibration_mm_s IGNORE NULLS) OVER w AS vibration_mm_s,
         last_value(pressure_bar IGNORE NULLS) OVER w AS pressure_bar, last_value(operator_id IGNORE NULLS) OVER w AS operator_id,
         last_value(units_produced IGNORE NULLS) OVER w AS units_produced,
         last_value(defective_units IGNORE NULLS) OVER w AS defective_units,
         last_value(production_time_min IGNORE NULLS) OVER w AS production_time_min
  FROM aligned WINDOW w AS (PARTITION BY machine_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
featured AS (
  SELECT f.*, units_produced / NULLIF(production_time_min, 0) AS throughput,
         defective_units::DOUBLE / NULLIF(units_produced, 0) AS defect_rate,
         power_kw * (production_time_min / 60.0::DOUBLE) / NULLIF(units_produced, 0) AS energy_efficiency,
         (SELECT count(DISTINCT b.machine_id) FROM aligned b WHERE b.machine_id < f.machine_id)::DOUBLE AS machine_code,
         CASE WHEN machine_status IS NOT NULL THEN (SELECT count(DISTINCT b.machine_status) FROM aligned b WHERE b.machine_status < f.machine_status)::DOUBLE END AS status_code,
         CASE WHEN alarm_code IS NOT NULL THEN (SELECT count(DISTINCT b.alarm_code) FROM aligned b WHERE b.alarm_code < f.alarm_code)::DOUBLE END AS alarm_code_no
  FROM filled f),
kpi AS (
  SELECT m.event_id, m.ts, m.machine_id, m.operator_id, m.units_produced, m.defective_units, m.production_time_min,
         s.power_kw, s.machine_status, s.alarm_code, i.temperature_c, i.vibration_mm_s, i.pressure_bar,
         m.production_time_min / NULLIF(m.units_produced, 0) AS time_per_unit,
         m.defective_units::DOUBLE / NULLIF(m.units_produced, 0) AS defect_rate,
         m.defective_units::DOUBLE / NULLIF(m.units_produced, 0) * 100 AS defect_pct,
         s.power_kw / NULLIF(m.units_produced, 0) AS energy_per_unit
  FROM mes_h m LEFT JOIN scada_h s USING (ts, machine_id) LEFT JOIN iot_h i USING (ts, machine_id)),
affinity AS (
  SELECT operator_id, machine_id, 1 - sum(defective_units)::DOUBLE / NULLIF(sum(units_produced), 0) AS affinity
  FROM mes GROUP BY ALL),
rated AS (
  SELECT operator_id, machine_id, 1 - defective_units::DOUBLE / units_produced AS rate,
         row_number() OVER (PARTITION BY operator_id, machine_id ORDER BY ts DESC) AS age
  FROM mes WHERE units_produced > 0),
running AS (
  SELECT operator_id, machine_id, 0.5 * pow(0.5::DOUBLE, max(age)) + sum(rate * pow(0.5::DOUBLE, age)) AS affinity
  FROM rated GROUP BY ALL),
latest AS (
  SELECT machine_id, max(ts) AS ts, arg_max(temperature_c, event_id) FILTER (temperature_c IS NOT NULL) AS temperature_c,
         arg_max(vibration_mm_s, event_id) FILTER (vibration_mm_s IS NOT NULL) AS vibration_mm_s,
         arg_max(pressure_bar, event_id) FILTER (pressure_bar IS NOT NULL) AS pressure_bar,
         arg_max(power_kw, event_id) FILTER (power_kw IS NOT NULL) AS power_kw,
         arg_max(machine_status, event_id) FILTER (machine_status IS NOT NULL) AS machine_status,
         arg_max(alarm_code, event_id) FILTER (alarm_code IS NOT NULL) AS alarm_code,
         arg_max(operator_id, event_id) FILTER (operator_id IS NOT NULL) AS operator_id,
         arg_max(units_produced, event_id) FILTER (units_produced IS NOT NULL) AS units_produced,
         arg_max(defective_units, event_id) FILTER (defective_units IS NOT NULL) AS defective_units,
         arg_max(production_time_min, event_id) FILTER (production_time_min IS NOT NULL) AS production_time_min
  FROM events_long GROUP BY machine_id)
"""


def over(body: str, *ctes: str, recursive: bool = False) -> str:
    """``body`` with the views, and further named parts, in front."""
    parts = ",\n".join([VIEWS.strip(), *ctes])
    return f"WITH {'RECURSIVE ' if recursive else ''}{parts}\n{body}"
