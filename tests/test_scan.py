import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import affinity, align, metrics, quantiles
from millrace.operators.scan import Fill, cut_slices, fill, running_sum, time_slice

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(3)
    out, second = [], 0
    for i in range(600):
        second += draw.randint(1, 900)
        key = "a" if draw.random() < 0.5 else draw.choice("bcd")
        out.append((key, START + dt.timedelta(seconds=second), i, draw.random() if draw.random() < 0.2 else None))
    return out


SCHEMA = "k string, ts timestamp_ntz, n long, v double"


@pytest.mark.parametrize("width", [60, 3600, 10**7])
@pytest.mark.parametrize("backward", [False, True])
def test_fill_is_independent_of_the_slices(spark, rows, width, backward):
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {r["n"]: r["f"] for r in fill(frame, ["k"], ["ts"], time_slice("ts", width), [Fill("f", "v", backward)]).collect()}
    want, last = {}, {}
    for k, _, n, v in reversed(rows) if backward else rows:
        last[k] = v if v is not None else last.get(k)
        want[n] = last[k]
    assert got == want


@pytest.mark.parametrize("by", [[], ["k"]])
@pytest.mark.parametrize("descending", [False, True])
def test_running_sum(spark, rows, by, descending):
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {r["n"]: r["s"] for r in running_sum(frame, by, ["ts"], time_slice("ts", 3600), "s", F.col("n"), descending).collect()}
    want, total = {}, {}
    for k, _, n, _ in reversed(rows) if descending else rows:
        key = k if by else ""
        total[key] = total.get(key, 0) + n
        want[n] = total[key]
    assert got == want


def test_forward_fill_stays_within_a_machine(spark):
    day = dt.timedelta(days=1)
    frame = spark.createDataFrame(
        [(START, "m1", 1.0), (START + 3 * day, "m1", None), (START + 4 * day, "m2", None), (START + 5 * day, "m2", 2.0)],
        "ts timestamp_ntz, machine_id string, v double",
    )
    assert [r["v"] for r in align.forward_fill(frame).orderBy("ts").collect()] == [1.0, 1.0, None, 2.0]


@pytest.mark.parametrize("width", [0.01, 0.5, 1000.0])
def test_exact_quantiles(spark, width):
    draw = random.Random(5)
    values = [round(draw.gauss(100, 9), 2) for _ in range(501)] + [100.0] * 250
    frame = spark.createDataFrame([("k", v) for v in values] + [("one", 4.0), ("none", None)], "k string, v double")
    qs = {"p10": 0.1, "p50": 0.5, "p90": 0.9}
    got = {r["k"]: r for r in quantiles.exact_quantiles(frame, ["k"], "v", qs, width).collect()}
    assert [got["k"][q] for q in qs] == pytest.approx(list(np.quantile(values, list(qs.values()))))
    assert got["k"]["n"] == 751 and got["one"]["p10"] == 4.0 and "none" not in got


def mes(spark, rates):
    rows = [(1000, "Machine_1", START + dt.timedelta(days=i), 10, int(round(10 - 10 * r))) for i, r in enumerate(rates)]
    return spark.createDataFrame(rows, "operator_id int, machine_id string, ts timestamp_ntz, units_produced int, defective_units int")


def test_running_affinity(spark):
    assert affinity.running(mes(spark, [1.0])).first()["affinity"] == 0.75
    assert affinity.running(mes(spark, [1.0, 0.5])).first()["affinity"] == 0.625


def test_running_affinity_of_a_long_history(spark):
    draw = random.Random(2)
    rates = [draw.randint(0, 10) / 10 for _ in range(1500)]
    value = 0.5
    for r in rates:
        value = (value + r) / 2
    assert affinity.running(mes(spark, rates)).first()["affinity"] == pytest.approx(value, abs=1e-12)


def test_time_series_folds(spark):
    frame = spark.createDataFrame([(START + dt.timedelta(hours=i), "m") for i in range(20)], "ts timestamp_ntz, machine_id string")
    folds = [r["fold"] for r in metrics.time_series_folds(frame).orderBy("ts").collect()]
    assert folds == [0] * 5 + [1] * 3 + [2] * 3 + [3] * 3 + [4] * 3 + [5] * 3


def crowded(spark):
    draw = np.random.default_rng(8)
    near = 0.97 + draw.random(4000) * 1e-6
    values = [float(v) for v in [*near, *draw.random(400)]]
    rows = [("ab"[int(v * 1e9) % 5 == 0], v, "yes" if draw.random() < v - 0.4 else "no") for v in values]
    return spark.createDataFrame([*rows, *rows[:200], ("a", None, "no"), (None, 0.5, "yes")], "k string, v double, y string")


def test_sketch_cuts_give_even_slices_where_values_crowd(spark):
    frame = crowded(spark).where("v is not null and k is not null").select("k", "v").distinct()
    sliced = cut_slices(frame, ["k"], "v", "s", slices=16)
    sizes = sliced.groupBy("k", "s").count().toPandas()
    for _, part in sizes.groupby("k"):
        assert len(part) == 16 and part["count"].max() <= 2 * part["count"].mean()
    ends = sliced.groupBy("k", "s").agg(F.min("v").alias("low"), F.max("v").alias("high")).toPandas().sort_values(["k", "s"])
    for _, part in ends.groupby("k"):
        assert (part["high"].to_numpy()[:-1] < part["low"].to_numpy()[1:]).all()


@pytest.mark.parametrize("by", [[], ["k"]])
def test_quantiles_of_crowded_values_by_sketch_cuts(spark, by):
    rows = crowded(spark).where("k is not null")
    shares = {"q1": 0.25, "q2": 0.5, "q9": 0.99}
    found = quantiles.exact_quantiles(rows, by, "v", shares, width=None).toPandas()
    whole = rows.toPandas().dropna(subset=["v"])
    groups = whole.groupby(by, dropna=False)["v"] if by else [(None, whole["v"])]
    want = sorted((len(v), *(round(float(np.quantile(v, q)), 9) for q in shares.values())) for _, v in groups)
    assert sorted((r.n, *(round(getattr(r, c), 9) for c in shares)) for r in found.itertuples()) == want


def test_auc_of_crowded_scores_equals_all_pairs(spark):
    rows = crowded(spark).where("v is not null").withColumn("w", 1 - F.col("v"))
    found = {r["class"]: r["auc"] for r in metrics.auc_one_vs_rest(rows, "y", {"yes": "v", "no": "w"}).collect()}
    yes, no = (np.array([r["v"] for r in rows.where(f"y = '{c}'").collect()]) for c in ("yes", "no"))
    pairs = ((yes[:, None] > no).sum() + (yes[:, None] == no).sum() / 2) / (len(yes) * len(no))
    assert found["yes"] == pytest.approx(pairs, abs=1e-9) and found["no"] == pytest.approx(pairs, abs=1e-4)
    none = metrics.auc_one_vs_rest(rows.limit(0), "y", {"yes": "v"}).collect()
    assert none == []
