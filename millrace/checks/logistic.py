"""SQL of the fitted classifiers: Newton steps on the log loss, one set of named parts per step."""

from __future__ import annotations

from millrace.operators import align

ALPHA = 1e-3
FEATURES = align.STATE_FEATURES
SIZE = len(FEATURES) + 1
CODE = "(SELECT count(DISTINCT b.machine_id) FROM events_long b WHERE b.machine_id < {0}.machine_id)::DOUBLE AS machine_code"
SCALED = "[" + ", ".join(f"({c} - mean_{c}) / std_{c}" for c in FEATURES) + ", 1.0::DOUBLE]"


def _rows(label: str) -> str:
    names = ["power_kw", "machine_status", "alarm_code", "temperature_c", "vibration_mm_s", "pressure_bar"]
    filled = ", ".join(f"last_value({c} IGNORE NULLS) OVER w AS {c}" for c in names)
    scales = ", ".join(f"avg({c}) AS mean_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS std_{c}" for c in FEATURES)
    return f"""
state_filled AS (
  SELECT ts, machine_id, {filled} FROM (SELECT ts, machine_id, power_kw, machine_status, alarm_code FROM scada_h)
  FULL JOIN (SELECT ts, machine_id, temperature_c, vibration_mm_s, pressure_bar FROM iot_h) USING (ts, machine_id)
  WINDOW w AS (PARTITION BY machine_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
state_rows AS MATERIALIZED (
  SELECT *, {CODE.format('f')} FROM state_filled f WHERE {' AND '.join(f'{c} IS NOT NULL' for c in names)}),
scales AS MATERIALIZED (SELECT {scales} FROM state_rows),
pointed AS MATERIALIZED (SELECT row_number() OVER () AS id, {label} AS y, {SCALED} AS z FROM state_rows, scales),
w_0 AS (SELECT DISTINCT y AS class, [{', '.join(['0.0::DOUBLE'] * SIZE)}] AS w FROM pointed)"""


def _step(k: int) -> str:
    gradient = ", ".join(f"avg(e * z[{i}])" for i in range(1, SIZE + 1))
    curved = ", ".join("[" + ", ".join(f"avg(h * z[{min(i, j)}] * z[{max(i, j)}])" for j in range(1, SIZE + 1)) + "]" for i in range(1, SIZE + 1))
    grid = ", ".join(
        "[" + ", ".join(f"m[{i}][{j}]" + (f" + {ALPHA!r}::DOUBLE" if i == j < SIZE else "") for j in range(1, SIZE + 1))
        + f", g[{i}]" + (f" + {ALPHA!r}::DOUBLE * w[{i}]" if i < SIZE else "") + "]" for i in range(1, SIZE + 1))
    return f"""
sums_{k} AS MATERIALIZED (
  SELECT class, any_value(w) AS w, [{gradient}] AS g, [{curved}] AS m
  FROM (SELECT class, w, z, p - (y = class)::INTEGER AS e, p * (1 - p) AS h
        FROM (SELECT *, 1 / (1 + exp(-list_dot_product(w, z))) AS p FROM pointed, w_{k})) GROUP BY class),
grid_{k} AS (
  SELECT class, 0 AS k, [{grid}] AS a FROM sums_{k}
  UNION ALL
  SELECT class, k + 1, list_transform(a, lambda r, i: CASE WHEN i = k + 1 THEN p ELSE list_transform(r, lambda x, j: x - r[k + 1] * p[j]) END)
  FROM (SELECT class, k, a, list_transform(a[k + 1], lambda x: x / a[k + 1][k + 1]) AS p FROM grid_{k} WHERE k < {SIZE})),
w_{k + 1} AS MATERIALIZED (
  SELECT class, list_transform(s.w, lambda x, i: x - a[i][{SIZE + 1}]) AS w FROM grid_{k} g JOIN sums_{k} s USING (class) WHERE g.k = {SIZE})"""


def fitted(label: str, steps: int) -> list[str]:
    """Named parts up to ``fitted_model``: (class, w), the weights over the scaled features and 1."""
    return [_rows(label), *map(_step, range(steps)), f"fitted_model AS MATERIALIZED (SELECT * FROM w_{steps})"]


SCORED = """
scored AS MATERIALIZED (
  SELECT id, y, class, s / sum(s) OVER (PARTITION BY id) AS score
  FROM (SELECT id, y, class, 1 / (1 + exp(-list_dot_product(w, z))) AS s FROM pointed, fitted_model)),
chosen AS MATERIALIZED (SELECT id, y, class AS guess FROM scored QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, class) = 1)"""

QUALITY = """
SELECT q.*, auc FROM (
  SELECT CAST(sum(support) AS BIGINT) AS n, sum(hits) / sum(support) AS accuracy, sum(p * support) / sum(support) AS precision,
         sum(r * support) / sum(support) AS recall, sum(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END * support) / sum(support) AS f1
  FROM (SELECT support, hits, coalesce(hits / guessed, 0) AS p, hits / support AS r
        FROM (SELECT y AS class, count(*)::DOUBLE AS support, (count(*) FILTER (guess = y))::DOUBLE AS hits FROM chosen GROUP BY 1)
        LEFT JOIN (SELECT guess AS class, count(*)::DOUBLE AS guessed FROM chosen GROUP BY 1) USING (class))) q,
  (SELECT avg((ranks - pos * (pos + 1) / 2.0) / (pos * neg)) AS auc
   FROM (SELECT class, sum(r) FILTER (y = class) AS ranks, (count(*) FILTER (y = class))::DOUBLE AS pos, (count(*) FILTER (y <> class))::DOUBLE AS neg
         FROM (SELECT *, rank() OVER (PARTITION BY class ORDER BY score) + (count(*) OVER (PARTITION BY class, score) - 1) / 2.0 AS r FROM scored)
         GROUP BY class))"""


def forecast_sql(label: str) -> str:
    current = "CASE WHEN alarm_code = '' THEN 'None' ELSE alarm_code END" if label == "alarm_code" else label
    ready = " AND ".join(f"{c} IS NOT NULL" for c in FEATURES)
    return f"""
SELECT machine_id, class AS predicted, current
FROM (SELECT machine_id, {current} AS current, {SCALED} AS z FROM (SELECT *, {CODE.format('l')} FROM latest l), scales WHERE {ready}), fitted_model
QUALIFY row_number() OVER (PARTITION BY machine_id ORDER BY 1 / (1 + exp(-list_dot_product(w, z))) DESC, class) = 1"""
