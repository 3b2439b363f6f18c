import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.checks.rows import whole_fact
from millrace.plans import jobs, marts
from millrace.plans.changes import ChangeLog
from millrace.sources import events, files

FOLDER = "/root/testdata/sf0.001"


def test_fact_and_marts_from_files(spark, tmp_path):
    for name, view in events.FEEDS.items():
        files.write_feed_csv(view(events.read_events(spark, FOLDER)), str(tmp_path / name), name)
    load = ["fact", *[part for name in events.FEEDS for part in (f"--{name}", str(tmp_path / name))], "--out", str(tmp_path / "fact")]
    for _ in range(2):
        jobs.main(load)
    table = spark.read.parquet(str(tmp_path / "fact"))
    want = whole_fact(spark, FOLDER)
    assert table.count() == want.count()
    assert table.agg(F.count("power_kw")).first()[0] == want.agg(F.count("power_kw")).first()[0]
    jobs.main(["marts", "--fact", str(tmp_path / "fact"), "--out", str(tmp_path / "marts")])
    before = spark.read.parquet(str(tmp_path / "marts" / "units_week"))
    rows = sorted(map(repr, before.select("machine_id", F.col("period").cast("string"), "units_produced").collect()))
    jobs.main(["marts", "--fact", str(tmp_path / "fact"), "--out", str(tmp_path / "marts"), "--since", "2024-01-17"])
    after = spark.read.parquet(str(tmp_path / "marts" / "units_week"))
    assert sorted(map(repr, after.select("machine_id", F.col("period").cast("string"), "units_produced").collect())) == rows
    days = spark.read.parquet(str(tmp_path / "marts" / "power_day"))
    assert days.count() == marts.power(table, "day").count() and days.agg(F.min("period")).first()[0] == dt.date(2024, 1, 1)


def test_replacing_keeps_the_period_of_rows_without_one(spark, tmp_path):
    path = str(tmp_path / "mart")
    for _ in range(2):
        jobs._replace(spark.createDataFrame([("a", "2024-01"), ("b", None), ("c", "2024-02")], "name string, period string"), path, "period", None)
    assert sorted(r["name"] for r in spark.read.parquet(path).collect()) == ["a", "b", "c"]
    jobs._replace(spark.createDataFrame([("d", "2024-01")], "name string, period string"), path, "period", None, {"2024-01", "2024-02"})
    assert sorted(r["name"] for r in spark.read.parquet(path).collect()) == ["b", "d"]


def test_change_log_forgets_only_what_was_refreshed(spark, tmp_path):
    log, seen = ChangeLog(spark, str(tmp_path / "log")), []
    one, two = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    assert log.consume(seen.append) == [] and seen == []
    log.write([one, two], "a")
    log.write([one, two], "a")
    log.write([], "none")
    log.write([two], "b")

    def fail(days):
        raise RuntimeError

    with pytest.raises(RuntimeError):
        log.consume(fail)

    def refresh(days):
        seen.append(days)
        log.write([one], "meanwhile")

    assert log.consume(refresh) == [one, two] and log.consume(seen.append) == [one] and log.consume(seen.append) == []
    assert seen == [[one, two], [one]]


def test_refresh_of_named_days_equals_a_whole_one(spark, tmp_path):
    rows = whole_fact(spark, FOLDER).withColumn("day", F.to_date("ts"))
    jobs.refresh_marts(rows, str(tmp_path / "whole"))
    gone = rows.where("day <> DATE '2024-01-09'")
    jobs.refresh_marts(gone, str(tmp_path / "whole"), days=[dt.date(2024, 1, 9)])
    jobs.refresh_marts(gone, str(tmp_path / "again"))
    for name in ("power_day", "efficiency_week", "failures_month", "plant_power_day"):
        found = [sorted(map(repr, spark.read.parquet(str(tmp_path / x / name)).select("*").collect())) for x in ("whole", "again")]
        assert found[0] == found[1]
