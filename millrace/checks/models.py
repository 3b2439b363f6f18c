"""Checks of encodings, scaling, gradient steps and fitted models."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from millrace.checks import centres, descents, logistic
from millrace.checks.registry import all_topics, check, feed, feeds, hourly
from millrace.checks.reports import CENTRES_CTE, energy_points, performance_rows
from millrace.functions import kpis
from millrace.operators import affinity, align, clustering, linear, metrics, scaling, state
from millrace.operators.density import DensityClustering
from millrace.operators.linear import Weights
from millrace.plans import forecasts, performance
from millrace.plans.model_store import ModelStore
from millrace.session import fresh_path, written


def training_rows(spark, folder):
    iot, scada, mes = hourly(spark, folder)
    return align.features(scada, iot, mes, feed_codes(spark, folder))


def feed_codes(spark, folder):
    iot, scada, mes = feeds(spark, folder)
    return align.codes(scada, iot, mes)


@check("label_encode", "SELECT ts, machine_id, machine_code, status_code, alarm_code_no FROM featured")
def label_encode(spark, folder):
    return training_rows(spark, folder).select("ts", "machine_id", "machine_code", "status_code", "alarm_code_no")


@check("features_power", f"SELECT ts, {', '.join(align.POWER_FEATURES)} FROM featured WHERE {' AND '.join(c + ' IS NOT NULL' for c in align.POWER_FEATURES)}",
       doubles=" ".join(align.POWER_FEATURES))
def features_power(spark, folder):
    return align.complete(training_rows(spark, folder), align.POWER_FEATURES).select("ts", *align.POWER_FEATURES)


@check("features_units", f"SELECT ts, {', '.join(align.UNITS_FEATURES)} FROM featured WHERE {' AND '.join(c + ' IS NOT NULL' for c in align.UNITS_FEATURES)}",
       doubles=" ".join(align.UNITS_FEATURES))
def features_units(spark, folder):
    return align.complete(training_rows(spark, folder), align.UNITS_FEATURES).select("ts", *align.UNITS_FEATURES)


SENSORS = ["temperature_c", "vibration_mm_s", "pressure_bar"]


@check("scaler_fit", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, avg({c}) AS mean, stddev_pop({c}) AS std FROM iot" for c in SENSORS), doubles="mean std")
def scaler_fit(spark, folder):
    return scaling.fit_table(feed(spark, folder, "iot"), SENSORS)


@check("scaler_transform", "SELECT event_id, " + ", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}" for c in SENSORS) + " FROM iot",
       doubles=" ".join(SENSORS))
def scaler_transform(spark, folder):
    iot = feed(spark, folder, "iot")
    return scaling.Scaler.fit(iot, SENSORS).transform(iot).select("event_id", *SENSORS)


FIXED = Weights(tuple(0.1 * (j + 1) for j in range(len(align.POWER_FEATURES))), 0.5)
DOT = " + ".join(f"{w!r}::DOUBLE * {c}" for w, c in zip(FIXED.coefficients, align.POWER_FEATURES)) + " + 0.5"
COMPLETE = f"(SELECT * FROM featured WHERE {' AND '.join(c + ' IS NOT NULL' for c in [*align.POWER_FEATURES, 'power_kw'])})"


@check("linear_predict", f"SELECT ts, machine_id, round({DOT}, 2) AS predicted FROM {COMPLETE}")
def linear_predict(spark, folder):
    rows = align.complete(training_rows(spark, folder), [*align.POWER_FEATURES, "power_kw"])
    return rows.select("ts", "machine_id", F.round(linear.predicted(align.POWER_FEATURES, FIXED), 2).alias("predicted"))


@check("sgd_step", "SELECT " + ", ".join(
    f"{w!r}::DOUBLE * (1 - 1e-4 * 1e-3) - 1e-4 * avg(d * {c}) AS w_{i}" for i, (w, c) in enumerate(zip(FIXED.coefficients, align.POWER_FEATURES)))
    + f", 0.5 - 1e-4 * avg(d) AS b FROM (SELECT *, {DOT} - power_kw AS d FROM {COMPLETE})",
       doubles=" ".join([f"w_{i}" for i in range(len(align.POWER_FEATURES))] + ["b"]))
def sgd_step(spark, folder):
    rows = align.complete(training_rows(spark, folder), [*align.POWER_FEATURES, "power_kw"])
    return linear.gradient_step(rows, align.POWER_FEATURES, "power_kw", FIXED, 1e-4, 1e-3)


@check("argmax_decode", """
SELECT event_id, CASE WHEN p0 >= p1 AND p0 >= p2 THEN 'Error' WHEN p1 >= p2 THEN 'Idle' ELSE 'Running' END AS predicted FROM
(SELECT event_id, 1 / (1 + abs(power_kw - 103)) AS p0, 1 / (1 + abs(power_kw - 111)) AS p1, 1 / (1 + abs(power_kw - 158)) AS p2 FROM scada)""")
def argmax_decode(spark, folder):
    """The class of the greatest score, the first in text order on a tie."""
    scores = {k: 1 / (1 + F.abs(F.col("power_kw") - c)) for k, c in (("Error", 103.0), ("Idle", 111.0), ("Running", 158.0))}
    rows = feed(spark, folder, "scada")
    return rows.select("event_id", linear.best_class(scores).alias("predicted"))


# --- fits (descents against one recursive step each; the tests check bounds of the rest)


def state_training(spark, folder):
    iot, scada, _ = hourly(spark, folder)
    rows = align.coded(align.forward_fill(align.outer(scada, iot)), feed_codes(spark, folder))
    return written(align.complete(rows, [*align.STATE_FEATURES, "machine_status", "alarm_code"]), "training")


LABELS = {"status": "machine_status", "alarm": "alarm_code"}
# More than any class of the given tables needs until no weight moves.
NEWTON_STEPS = 16


def _classifier(label, spark, folder):
    rows = state_training(spark, folder)
    model = linear.fit_classifier(rows, align.STATE_FEATURES, label)
    scored = written(model.transform(rows), "scored")
    auc = metrics.macro_auc(scored, label, {k: f"score_{i}" for i, k in enumerate(model.classes)})
    return metrics.classification(scored, label, "predicted").withColumn("auc", auc.scalar())


for _key, _label in LABELS.items():
    check(f"{_key}_model", logistic.QUALITY, [*logistic.fitted(_label, NEWTON_STEPS), logistic.SCORED], "accuracy precision recall f1 auc",
          recursive=True)(partial(_classifier, _label))

TARGET_KEYS = {"power": "power_kw", "units": "units_produced", "defects": "defective_units", "minutes": "production_time_min"}


def _regressor(target, spark, folder):
    """Quality of each variant on the training rows."""
    rows = written(align.complete(training_rows(spark, folder), [*forecasts.FEATURES[target], target]), "training")
    out = None
    for name, model in forecasts.fit_target(rows, target).items():
        part = metrics.regression(rows.withColumn("predicted", model.prediction()), target, "predicted").withColumn("variant", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


for _key, _target in TARGET_KEYS.items():
    check(f"{_key}_model", descents.quality_sql(), descents.fitted(_target), descents.METRICS, recursive=True)(partial(_regressor, _target))


def _current(spark, folder):
    latest = state.latest_state(all_topics(spark, folder)).withColumn("alarm_code", F.when(F.col("alarm_code") == "", "None").otherwise(F.col("alarm_code")))
    return forecasts.coded_state(latest, feed_codes(spark, folder))


def _forecast(target, spark, folder):
    training = training_rows(spark, folder)
    return forecasts.forecast(_current(spark, folder), target, forecasts.fit_target(training, target))


for _key, _target in TARGET_KEYS.items():
    check(f"forecast_{_key}", descents.forecast_sql(_target), descents.fitted(_target), recursive=True)(partial(_forecast, _target))


def _forecast_class(label, spark, folder):
    training = state_training(spark, folder)
    model = linear.fit_classifier(training, align.STATE_FEATURES, label)
    return forecasts.forecast_class(_current(spark, folder), label, model)


for _key, _label in LABELS.items():
    check(f"forecast_{_key}", logistic.forecast_sql(_label), logistic.fitted(_label, NEWTON_STEPS), recursive=True)(partial(_forecast_class, _label))


@check("model_save_load", "SELECT ts, machine_id, true AS same_status, true AS same_power FROM featured WHERE "
       + " AND ".join(f"{c} IS NOT NULL" for c in [*align.UNITS_FEATURES]))
def model_save_load(spark, folder):
    """Predictions of a stored regressor and classifier equal those of the originals on every row."""
    rows = written(align.complete(training_rows(spark, folder), align.UNITS_FEATURES), "training")
    regressor = linear.fit_least_squares(rows, align.POWER_FEATURES, "power_kw")
    classifier = linear.fit_classifier(rows, align.STATE_FEATURES, "machine_status")
    loaded = []
    for name, model in (("power", regressor), ("status", classifier)):
        path = fresh_path(spark, name)
        forecasts.save(model, spark, path)
        loaded.append(forecasts.load(spark, path))
    status, status_loaded = (linear.best_class(m.probabilities()) for m in (classifier, loaded[1]))
    return rows.select(
        "ts", "machine_id", (status == status_loaded).alias("same_status"),
        (regressor.prediction() == loaded[0].prediction()).alias("same_power"),
    )


_POWER_SQL = descents.forecast_sql("power_kw")
_PUBLISHED = ["raw", "scaled", "decaying", "closed_form"]


@check("model_versions", " UNION ALL ".join(
    f"SELECT {v} AS version, {origin} AS restored_from, {kept} AS kept, machine_id, predicted_{name} AS predicted FROM ({_POWER_SQL})"
    for v, (name, origin, kept) in enumerate([*[(n, "NULL::INTEGER", str(n == "closed_form").lower()) for n in _PUBLISHED], ("scaled", "2", "true")], 1)),
       descents.fitted("power_kw"), recursive=True)
def model_versions(spark, folder):
    """Power forecasts of each published version, then of the current one after a roll-back to the second."""
    store, now = ModelStore(spark, fresh_path(spark, "models")), written(_current(spark, folder), "current")
    fitted = forecasts.fit_target(training_rows(spark, folder), "power_kw")
    for name in _PUBLISHED:
        store.publish("power", fitted[name])
    store.roll_back("power", 2)
    history = {r["version"]: r["restored_from"] for r in store.history("power").collect()}
    models = {v: store.load("power", v) for v in store.versions("power")}
    gone, out = store.expire("power", keep=2), None
    for version, model in models.items():
        rows = forecasts.forecast(now, "power_kw", {"it": model}).select(
            F.lit(version).alias("version"), F.lit(history[version]).cast("int").alias("restored_from"),
            F.lit(version not in gone).alias("kept"), "machine_id", F.col("predicted_it").alias("predicted"))
        out = rows if out is None else out.unionByName(rows)
    return out


def centre_rows(spark, fit, features):
    rows = [(i, *map(float, c), fit.cost, fit.rounds, fit.converged) for i, c in enumerate(fit.centres)]
    fields = ", ".join(f"{c} double" for c in features)
    return spark.createDataFrame(rows, f"cluster int, {fields}, cost double, rounds int, converged boolean")


PERF_POINTS = "perf_points AS (SELECT [time_per_unit, defect_pct, affinity] AS x FROM perf)"


@check("perf_clusters", centres.centre_rows("perf_fit", performance.PERFORMANCE, 3),
       [CENTRES_CTE, PERF_POINTS, *centres.fitted("perf_fit", "perf_points", 3, 3)],
       "cost " + " ".join(performance.PERFORMANCE), recursive=True)
def perf_clusters(spark, folder):
    """Three performance clusters of all production rows; centres in tier order."""
    rows = performance_rows(spark, folder).select(*performance.PERFORMANCE)
    return centre_rows(spark, clustering.fit_kmeans(rows, performance.PERFORMANCE, 3), performance.PERFORMANCE)


PROFILES = {"performance": performance.PROFILE_PERFORMANCE, "energy": performance.PROFILE_ENERGY}


def _profile_points(name, features):
    """Scaled points of the filled production rows that have all features."""
    scales = ", ".join(f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS s_{c}" for c in features)
    complete = " AND ".join(f"{c} IS NOT NULL" for c in features)
    scaled = ", ".join(f"({c} - m_{c}) / s_{c}" for c in features)
    return (f"{name}_scaled AS (SELECT [{scaled}] AS x FROM profile, (SELECT {scales} FROM profile WHERE {complete}) WHERE {complete})")


PROFILE_CTE = """
profile AS MATERIALIZED (
  SELECT time_per_unit, defect_rate, last_value(power_kw IGNORE NULLS) OVER w AS power_kw,
         last_value(temperature_c IGNORE NULLS) OVER w AS temperature_c, last_value(vibration_mm_s IGNORE NULLS) OVER w AS vibration_mm_s
  FROM kpi WINDOW w AS (PARTITION BY machine_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


@check("profile_clusters",
       " UNION ALL ".join(f"SELECT *, '{n}' AS profile FROM ({centres.centre_rows(f'{n}_fit', ['x', 'y', 'z'], len(f))})" for n, f in PROFILES.items()),
       [PROFILE_CTE, *[part for n, f in PROFILES.items() for part in (_profile_points(n, f), *centres.fitted(f"{n}_fit", f"{n}_scaled", 5, len(f)))]],
       "x y z cost", recursive=True)
def profile_clusters(spark, folder):
    """Five clusters on scaled [time, defects] and five on scaled [power, temperature, vibration]."""
    iot, scada, mes = hourly(spark, folder)
    rows = written(align.forward_fill(align.left_of_mes(mes, scada, iot)), "profile")
    rows = rows.withColumns({"time_per_unit": kpis.time_per_unit(), "defect_rate": kpis.defect_rate()})
    out = None
    for name, features in PROFILES.items():
        used = rows.na.drop(subset=features)
        fit = clustering.fit_kmeans(scaling.Scaler.fit(used, features).transform(used), features, 5)
        padded = fit._replace(centres=[c + [0.0] * (3 - len(c)) for c in fit.centres])
        part = centre_rows(spark, padded, ["x", "y", "z"]).withColumn("profile", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


@check("retrain_snapshot")
def retrain_snapshot(spark, folder):
    """Both cluster models fitted on the current state of all machines."""
    mes = feed(spark, folder, "mes")
    current = written(performance.performance_state(mes, affinity.running(mes)).na.drop(subset=performance.PERFORMANCE), "current")
    fitted = clustering.fit_kmeans(current, performance.PERFORMANCE, 3)
    rows, scaler = energy_points(spark, folder)
    now = written(performance.energy_state(all_topics(spark, folder)).na.drop(), "now")
    numbered = now.withColumn("id", F.substring_index("machine_id", "_", -1).cast("long"))
    labels = DensityClustering(scaler.transform(numbered), performance.ENERGY, id_="id").labels()
    placed = clustering.assign(current, performance.PERFORMANCE, fitted.centres, "performance_cluster")
    return numbered.join(labels, "id").select("machine_id", F.col("label").alias("energy_label")).join(
        placed.select("machine_id", "performance_cluster"), "machine_id", "full"
    )


@check("retrain_report")
def retrain_report(spark, folder):
    """Both models fitted on the whole history, with their quality and health."""
    rows = written(performance_rows(spark, folder).select(*performance.PERFORMANCE), "performance")
    fitted = clustering.fit_kmeans(rows, performance.PERFORMANCE, 3)
    placed = written(clustering.assign(rows, performance.PERFORMANCE, fitted.centres), "placed")
    points, scaler = energy_points(spark, folder)
    scaled = written(scaler.transform(points), "scaled")
    labels = DensityClustering(scaled, performance.ENERGY).labels()
    labelled = written(scaled.join(labels, scaled["event_id"] == labels["id"]).select(*performance.ENERGY, F.col("label").alias("cluster")), "labelled")
    out = None
    for name, table, features in (("performance", placed, performance.PERFORMANCE), ("energy", labelled, performance.ENERGY)):
        quality = written(performance.cluster_quality(table, features), "quality")
        health = performance.health(quality, energy=name == "energy")
        part = quality.select(F.lit(name).alias("model"), "*", *[health.select(c).scalar().alias(c) for c in health.columns])
        out = part if out is None else out.unionByName(part)
    return out
