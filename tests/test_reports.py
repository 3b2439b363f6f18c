import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.operators import metrics
from millrace.plans import anomalies

START = dt.datetime(2024, 1, 1)


def readings(spark, values, machine="m"):
    rows = [(i, machine, START + dt.timedelta(hours=i), float(v) if v is not None else None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "event_id long, machine_id string, ts timestamp_ntz, power_kw double")


@pytest.mark.parametrize("n", [0, 4])
def test_too_few_readings(spark, n):
    rows = readings(spark, [100.0] * n + [None] * 3)
    assert anomalies.detect(rows).count() == 0
    found = anomalies.insufficient(rows).first()
    assert (found["available_readings"], found["status"], found["required_readings"]) == (n, "insufficient_data", 10)
    assert found["last_data_points"] == (",".join(f"2024-01-01 0{h}:00:00" for h in (1, 2, 3)) if n else None)


@pytest.mark.parametrize("n, method, points", [(5, "MAD", 5), (9, "MAD", 9), (10, "Z-score", 10), (24, "Z-score", 24), (30, "Z-score", 24)])
def test_method_by_number_of_readings(spark, n, method, points):
    found = anomalies.detect(readings(spark, range(100, 100 + n))).first()
    assert (found["method"], found["data_points"]) == (method, points)
    assert found["hours_covered"] == n - 1
    assert anomalies.insufficient(readings(spark, range(n))).count() == 0


def test_robust_score(spark):
    values = [100, 101, 102, 103, 130]
    mad = 1.4826 * 1.0
    score = min(1.0, 0.5 + abs(0.6745 * (130 - 102) / mad) / 3)
    found = anomalies.detect(readings(spark, values)).first()
    assert found["score"] == pytest.approx(score) and found["is_anomaly"] and found["trigger"] == "Limited historical data"


def test_constant_readings(spark):
    for n in (6, 20):
        found = anomalies.detect(readings(spark, [120.0] * n)).first()
        assert (found["score"], found["is_anomaly"], found["confidence"]) == (0.5, False, 0.6)


def test_peak_ratio_of_a_single_record(spark):
    assert anomalies.peak_ratio(readings(spark, [150.0])).first()["peak_ratio"] == 1.0
    assert anomalies.peak_ratio(readings(spark, [100.0, None, 200.0]), missing_as_zero=True).first()["peak_ratio"] == 2.0


def test_classification_with_a_class_never_guessed(spark):
    rows = spark.createDataFrame([("a", "a"), ("a", "b"), ("c", "b")], "y string, p string")
    found = metrics.classification(rows, "y", "p").first()
    assert found["accuracy"] == pytest.approx(1 / 3) and found["precision"] == pytest.approx(2 / 3)
    assert found["recall"] == pytest.approx(1 / 3) and found["f1"] == pytest.approx(2 / 3 * 2 / 3)


def test_auc_counts_ties_as_half(spark):
    rows = spark.createDataFrame([("x", 0.9), ("x", 0.5), ("y", 0.5), ("y", 0.1)], "label string, s double")
    found = metrics.auc_one_vs_rest(rows, "label", {"x": "s"}).first()
    assert found["auc"] == pytest.approx(3.5 / 4)


def test_health(spark):
    rows = spark.createDataFrame([(0.7, 0.0, 0.0), (0.35, 1.0, 0.05), (0.0, 2.0, 0.1), (None, None, None)], "s double, d double, n double")
    score = metrics.health_score(F.col("s"), F.col("d"), F.col("n"))
    assert [r[0] for r in rows.select(metrics.health_grade(score)).collect()] == ["HEALTHY", "DEGRADED", "CRITICAL", "UNKNOWN"]


def test_registered_marts_read_the_whole_fact_table(spark, monkeypatch):
    from millrace.checks import registry, rows

    iot, scada, mes = registry.feeds(spark, "/root/testdata/sf0.001")
    scada = scada.withColumn("machine_status", F.lit("Unheard")).withColumn("alarm_code", F.lit("None"))
    monkeypatch.setattr(rows, "feeds", lambda *_: (iot, scada, mes))
    found = registry.QUERIES["failures_day"](spark, "/root/testdata/sf0.001").collect()
    assert sum(r["failure_count"] for r in found) == 0  # a status without an entry is null in the fact table
