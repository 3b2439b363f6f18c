"""Rows and fits that must not be lost without a word."""

import datetime as dt
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import linear, upsert
from millrace.plans import jobs

ROWS = "event_id long, ts timestamp, machine_id string, temperature_c double"
T0 = dt.datetime(2024, 1, 1, 8)


@pytest.mark.parametrize("load", [upsert.insert_new, upsert.upsert])
def test_rows_without_a_key_are_kept_apart_once(spark, tmp_path, load):
    path = str(tmp_path / "table")
    first = spark.createDataFrame([(1, T0, "M1", 1.0), (2, None, "M1", 2.0), (3, T0, None, 3.0)], ROWS)
    second = spark.createDataFrame([(4, None, "M1", 4.0), (5, T0, "M2", 5.0)], ROWS)
    for rows in (first, first, second, second):
        load(rows, path)
    table = spark.read.parquet(path)
    assert sorted(r["event_id"] for r in table.collect()) == [1, 5]
    rejects = spark.read.parquet(upsert.rejects_path(path))
    assert sorted(r["event_id"] for r in rejects.collect()) == [2, 3, 4]


def test_an_overflow_keeps_the_weights_before(spark):
    rows = spark.range(400).select(F.lit(1.0).alias("x"), F.when(F.col("id") < 200, 1.0).otherwise(1e200).alias("y"), "id")
    rows = rows.withColumn("x", F.when(F.col("id") < 200, 1.0).otherwise(1e200)).repartitionByRange(2, "id")
    start = linear.Weights((0.25,), 0.5)
    assert linear.descend(rows, ["x"], "y", linear.RAW, 3, start=start) == start


def test_descent_depends_neither_on_batch_size_nor_on_partitions(spark):
    rows = spark.range(4000).select((F.col("id") % 701 / 7).alias("x"), (F.col("id") % 701 * 2.0 + 1).alias("y"))
    found = set()
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    for size, spread in (("100", rows.coalesce(1)), ("9600", rows.repartition(7)), ("10000", rows.orderBy(F.desc("x")))):
        spark.conf.set(setting, size)
        w = linear.descend(spread, ["x"], "y", linear.DECAYING, 3)
        found.add((round(w.coefficients[0], 9), round(w.intercept, 9)))
    spark.conf.set(setting, before)
    assert len(found) == 1


def test_descent_without_complete_rows_keeps_its_start(spark):
    rows = spark.createDataFrame([(None, 1.0), (2.0, None)], "x double, y double")
    start = linear.Weights((0.25,), 0.5)
    assert linear.descend(rows, ["x"], "y", linear.SCALED, 3, start=start) == start


def test_descent_equals_its_steps_by_hand(spark):
    draw = np.random.default_rng(5)
    x = draw.normal(size=(90, 2))
    y = x @ [1.5, -2.0] + 3.0
    rows = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))], "id long, a double, b double, y double")
    schedule = linear.Schedule(eta=1e-2, alpha=1e-2, power=0.25)
    found = linear.descend(rows, ["a", "b"], "y", schedule, 2, key=["id"], batches=5, gain=4)
    batch = np.array([int(hashlib.md5(str(i).encode()).hexdigest()[:4], 16) % 5 for i in range(90)])
    w, b, done = np.zeros(2), 0.0, 0
    for _ in range(2):
        for k in range(5):
            part, goal = x[batch == k], y[batch == k]
            eta, error = 4 * schedule.step(1 + 4 * done), part @ w + b - goal
            w, b = w * (1 - eta * 1e-2) - eta * (error @ part) / len(goal), b - eta * error.mean()
            done += 1
    assert [*found.coefficients, found.intercept] == pytest.approx([*w, b])


@pytest.mark.parametrize("since", [None, "2024-01-02"])
def test_a_period_that_became_empty_leaves_the_mart(spark, tmp_path, since):
    path = str(tmp_path / "mart")
    rows = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 3)], "period string, n int")
    rows = rows.withColumn("period", F.to_date("period"))
    jobs._replace(rows, path, "period", None)
    jobs._replace(rows.where("n = 2" if since else "n <> 3"), path, "period", since)
    assert sorted(r["n"] for r in spark.read.parquet(path).collect()) == [1, 2]
