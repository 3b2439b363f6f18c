"""SQL of the fitted regressors: sums per mini-batch, then one step of all descents per recursion."""

from __future__ import annotations

from dataclasses import dataclass

from millrace.operators import align, linear
from millrace.operators.linear import Schedule
from millrace.plans import forecasts

METRICS = "mse mae rmse r2 error_mean error_std error_min error_max"


@dataclass(frozen=True)
class Variant:
    name: str
    form: str
    schedule: Schedule
    gain: int


def variants(target: str) -> list[Variant]:
    return [
        Variant("raw", "raw", linear.RAW, 1), Variant("scaled", "scaled", linear.SCALED, 16),
        Variant("decaying", "scaled", forecasts.LAST_VARIANT[target], 16),
    ]


def fitted(target: str) -> list[str]:
    """Named parts up to ``models``: (variant, form, w), the weights over the features and 1."""
    features = forecasts.FEATURES[target]
    size = len(features) + 1
    used = " AND ".join(f"{c} IS NOT NULL" for c in [*features, target])
    scales = ", ".join(f"avg({c}) AS mean_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS std_{c}" for c in features)
    raw = ", ".join(f"{c}::DOUBLE" for c in features)
    scaled = ", ".join(f"({c} - mean_{c}) / std_{c}" for c in features)
    cells = [[f"sum(z[{min(i, j)}] * z[{max(i, j)}])" for j in range(1, size + 1)] for i in range(1, size + 1)]
    products = "[" + ", ".join(f"[{', '.join(line)}]" for line in cells) + "]"
    goals = "[" + ", ".join(f"sum(z[{i}] * y)" for i in range(1, size + 1)) + "]"
    settings = ", ".join(
        f"('{v.name}', '{v.form}', {v.schedule.eta!r}::DOUBLE, {v.schedule.alpha!r}::DOUBLE, {v.schedule.power!r}::DOUBLE, "
        f"{v.gain}, {str(v.schedule.averaged).lower()})" for v in variants(target))
    zero = "[" + ", ".join(["0.0::DOUBLE"] * size) + "]"
    error = "(list_dot_product(w, list_transform(m, lambda r: list_dot_product(r, w))) - 2 * list_dot_product(w, v) + yy) / n"
    ridge = "[" + ", ".join(
        "[" + ", ".join(f"m[{i}][{j}] / n" + (" + 1e-3::DOUBLE" if i == j < size else "") for j in range(1, size + 1)) + f", v[{i}] / n]"
        for i in range(1, size + 1)) + "]"
    return [
        f"rows_used AS MATERIALIZED (SELECT * FROM featured WHERE {used})",
        f"scales AS (SELECT {scales} FROM rows_used)",
        f"""pointed AS MATERIALIZED (
  SELECT {target}::DOUBLE AS y, ('0x' || substr(md5(ts::VARCHAR || '|' || machine_id), 1, 4))::INTEGER % {linear.BATCHES} AS b,
         [{raw}, 1.0] AS raw, [{scaled}, 1.0] AS scaled FROM rows_used, scales)""",
        "formed AS (SELECT 'raw' AS form, b, y, raw AS z FROM pointed UNION ALL SELECT 'scaled', b, y, scaled FROM pointed)",
        f"""batch_sums AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY form ORDER BY b) - 1 AS place, count(*) OVER (PARTITION BY form) AS places
  FROM (SELECT form, b, count(*) AS n, {products} AS m, {goals} AS v FROM formed GROUP BY form, b))""",
        f"all_sums AS MATERIALIZED (SELECT form, count(*) AS n, {products} AS m, {goals} AS v, sum(y * y) AS yy FROM formed GROUP BY form)",
        f"settings(variant, form, eta, alpha, power, gain, averaged) AS (VALUES {settings})",
        f"""steps AS (
  SELECT variant, form, eta, alpha, power, gain, averaged, 0::BIGINT AS done, {zero} AS w, {zero} AS mean FROM settings
  UNION ALL
  SELECT variant, form, eta, alpha, power, gain, averaged, done + 1, w, list_transform(mean, lambda x, j: x + (w[j] - x) / (done + 1))
  FROM (SELECT s.* REPLACE (list_transform(s.w, lambda x, j:
          x * (1 - CASE WHEN j < {size} THEN rate * alpha * gain ELSE 0 END) - rate * gain * (list_dot_product(m[j], s.w) - v[j]) / n) AS w)
        FROM (SELECT *, eta / pow(1 + gain * done, power) AS rate FROM steps) s
        JOIN batch_sums t ON t.form = s.form AND t.place = s.done % t.places WHERE s.done < {forecasts.PASSES} * t.places))""",
        f"""ends AS (
  SELECT variant, form, done, w, {error} AS error
  FROM (SELECT s.variant, s.form, s.done, CASE WHEN s.averaged THEN s.mean ELSE s.w END AS w, a.n, a.m, a.v, a.yy
        FROM steps s JOIN all_sums a USING (form) WHERE s.done % (SELECT max(places) FROM batch_sums) = 0))""",
        """descents AS (
  SELECT variant, form, arg_max(w, done) AS w
  FROM (SELECT *, bool_and(isfinite(error) AND error <= first) OVER (PARTITION BY variant ORDER BY done) AS fine
        FROM (SELECT *, first_value(error) OVER (PARTITION BY variant ORDER BY done) AS first FROM ends)) WHERE fine GROUP BY ALL)""",
        f"""elimination AS (
  SELECT 0 AS k, {ridge} AS a FROM all_sums WHERE form = 'scaled'
  UNION ALL
  SELECT k + 1, list_transform(a, lambda r, i: CASE WHEN i = k + 1 THEN p ELSE list_transform(r, lambda x, j: x - r[k + 1] * p[j]) END)
  FROM (SELECT k, a, list_transform(a[k + 1], lambda x: x / a[k + 1][k + 1]) AS p FROM elimination WHERE k < {size}))""",
        f"""models AS MATERIALIZED (
  SELECT * FROM descents UNION ALL
  SELECT 'closed_form', 'scaled', list_transform(a, lambda r: r[{size + 1}]) FROM elimination WHERE k = {size})""",
    ]


def quality_sql() -> str:
    return """
SELECT n, mse, mae, sqrt(mse) AS rmse, 1 - mse / NULLIF(spread, 0) AS r2, error_mean, error_std, error_min, error_max, variant
FROM (SELECT variant, count(*) AS n, avg(d * d) AS mse, avg(abs(d)) AS mae, var_pop(y) AS spread, avg(d) AS error_mean,
             stddev_pop(d) AS error_std, min(d) AS error_min, max(d) AS error_max
      FROM (SELECT variant, y, list_dot_product(w, CASE WHEN form = 'raw' THEN raw ELSE scaled END) - y AS d FROM models, pointed)
      GROUP BY variant)"""


def forecast_sql(target: str) -> str:
    features = forecasts.FEATURES[target]
    ready = " AND ".join(f"{c} IS NOT NULL" for c in features)
    raw = ", ".join(f"{c}::DOUBLE" for c in features)
    scaled = ", ".join(f"({c} - mean_{c}) / std_{c}" for c in features)
    columns = ", ".join(
        f"""CASE WHEN {ready} THEN round(list_dot_product((SELECT w FROM models WHERE variant = '{name}'),
         [{raw if name == 'raw' else scaled}, 1.0]), {forecasts.TARGETS[target]}) + 0.0 END AS predicted_{name}"""
        for name in [*[v.name for v in variants(target)], "closed_form"])
    code = "CASE WHEN {0} IN (SELECT {0} FROM {1}) THEN (SELECT count(DISTINCT o.{0}) FROM {1} o WHERE o.{0} < c.{0})::DOUBLE END"
    return f"""
SELECT machine_id, current, {', '.join(f'predicted_{n}' for n in [*[v.name for v in variants(target)], 'closed_form'])}
FROM (SELECT machine_id, {target} AS current, {columns} FROM (
  SELECT c.*, units_produced / NULLIF(production_time_min, 0) AS throughput,
         defective_units::DOUBLE / NULLIF(units_produced, 0) AS defect_rate,
         power_kw * (production_time_min / 60.0::DOUBLE) / NULLIF(units_produced, 0) AS energy_efficiency,
         {code.format('machine_id', 'events_long')} AS machine_code, {code.format('machine_status', 'scada')} AS status_code,
         {code.format('alarm_code', 'scada')} AS alarm_code_no
  FROM (SELECT * REPLACE (CASE WHEN alarm_code = '' THEN 'None' ELSE alarm_code END AS alarm_code) FROM latest) c), scales)"""
