import datetime as dt

from pyspark.sql import functions as F

from millrace.functions import clean, kpis
from millrace.plans import marts


def column(spark, rows, schema, expression):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expression).collect()]


def test_alarms(spark):
    rows = [("",), (None,), ("None",), ("Overheat",)]
    assert column(spark, rows, "a string", clean.norm_alarm("a")) == ["None", None, "None", "Overheat"]
    assert column(spark, rows, "a string", clean.denorm_alarm("a")) == ["", "", "", "Overheat"]


def test_failures_are_three_valued(spark):
    rows = [("Running", None), ("Error", None), (None, "None"), ("Idle", "Overheat"), ("Running", "None")]
    frame = spark.createDataFrame(rows, "machine_status string, alarm_code string")
    kept = [tuple(r) for r in frame.where(clean.is_failure()).collect()]
    assert kept == [("Error", None), ("Idle", "Overheat")]


def test_iso_weeks(spark):
    rows = [(dt.datetime(2024, 12, 30),), (dt.datetime(2024, 12, 29),), (dt.datetime(2021, 1, 3),)]
    assert column(spark, rows, "ts timestamp_ntz", clean.iso_week("ts")) == ["2025-W01", "2024-W52", "2020-W53"]


def test_machine_numbers(spark):
    assert column(spark, [("Machine_10",), ("Machine",), (None,)], "m string", clean.machine_no("m")) == [10, None, None]


def test_bad_times_give_null(spark):
    assert column(spark, [("not a time",), ("2024-01-02 03:04:05",)], "t string", clean.parse_ts("t").cast("string")) == [None, "2024-01-02 03:04:05"]


def test_zero_units(spark):
    schema = "units_produced int, defective_units int, production_time_min double, power_kw double"
    frame = spark.createDataFrame([(0, 0, 5.0, 1.0)], schema)
    columns = [kpis.defect_rate(), kpis.time_per_unit(), kpis.energy_per_unit(), kpis.energy_efficiency(), kpis.success_rate()]
    assert frame.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()[:] == (None,) * 5


def test_efficiency_of_an_idle_day_is_null(spark):
    rows = [(1, dt.datetime(2024, 1, 1), 0, 0), (2, dt.datetime(2024, 1, 1), 8, 1), (2, dt.datetime(2024, 1, 1), 8, 0)]
    fact = spark.createDataFrame(rows, "machine_id int, ts timestamp_ntz, units_produced int, defective_units int")
    assert {r["machine_id"]: r["efficiency_pct"] for r in marts.efficiency(fact, "day").collect()} == {1: None, 2: 93.75}


def test_missing_and_corrupt_fields(spark):
    frame = spark.createDataFrame([(None, "x"), ("1.5", None), ("abc", "y")], "a string, b string")
    assert [r[0] for r in frame.select(clean.missing_fields(["a", "b"])).collect()] == [["a"], ["b"], []]
    flagged = clean.split_numeric(frame, ["a"]).select("a", "is_corrupt").collect()
    assert [tuple(r) for r in flagged] == [(None, False), (1.5, False), (None, True)]


def test_gauge_levels(spark):
    assert column(spark, [(1.0,), (0.9,), (None,)], "v double", clean.gauge_level("v", 1.0)) == ["red", "green", None]


def test_keyless_rows_drop(spark):
    frame = spark.createDataFrame([("",), (None,), ("Machine_1",)], "machine_id string")
    assert clean.with_key(frame).count() == 1


def test_clip_keeps_null(spark):
    assert column(spark, [(None,), (-1.0,), (2.0,)], "v double", clean.clip(F.col("v"), 0.0, 1.0)) == [None, 0.0, 1.0]
