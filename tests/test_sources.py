import datetime as dt
import json

from millrace import schemas
from millrace.operators import upsert
from millrace.sources import dimensions, files, messages, metrics, tables


def test_messages_that_do_not_parse_are_marked(spark):
    good = {"Timestamp": "2024-01-01 00:00:00", "Machine_ID": "Machine_1", "Power_Consumption_kW": 1.5, "Alarm_Code": "", "Extra": 1}
    texts = [json.dumps(good), "{broken", json.dumps({**good, "Timestamp": "soon"})]
    rows = messages.parse(spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, offset long"), "scada").orderBy("offset").collect()
    assert [r["is_rejected"] for r in rows] == [False, True, True]
    assert (rows[0]["alarm_code"], rows[0]["power_kw"], rows[0]["machine_status"]) == ("None", 1.5, None)
    assert "Extra" not in rows[0].asDict() and rows[0]["offset"] == 0


def test_source_time_zone(spark):
    text = json.dumps({"Timestamp": "2024-01-01 08:00:00", "Machine_ID": "Machine_1"})
    row = messages.parse(spark.createDataFrame([(text,)], "value string"), "iot", "Asia/Singapore").selectExpr("string(ts)").first()
    assert row[0] == "2024-01-01 00:00:00"


def test_snapshots_without_time_or_alarm(spark):
    text = json.dumps({"Machine_2": {"Power_Consumption_kW": {"Value": 3.0}}, "Other": {"Value": "x"}})
    rows = messages.flatten_snapshot(spark.createDataFrame([(text,)], "value string"), "scada").collect()
    assert [(r["machine_id"], r["power_kw"], r["alarm_code"], r["machine_status"]) for r in rows] == [("Machine_2", 3.0, "", None)]
    assert rows[0]["ts"] is not None


def test_csv_keeps_the_text_none(spark, tmp_path):
    lines = "Timestamp,Machine_ID,Power_Consumption_kW,Machine_Status,Alarm_Code\n2024-01-01 00:00:00,Machine_1,1.0,Idle,None\n"
    (tmp_path / "scada.csv").write_text(lines)
    assert files.read_feed_csv(spark, str(tmp_path), "scada").first()["alarm_code"] == "None"
    assert files.read_feed_csv(spark, str(tmp_path), "scada", null_text="None").first()["alarm_code"] is None


def test_byte_order_mark(spark, tmp_path):
    (tmp_path / "operators.csv").write_bytes("﻿OperatorID\n1000\n1001".encode())
    assert sorted(r[0] for r in dimensions.read_csv(spark, str(tmp_path), "operators").collect()) == [1000, 1001]


def test_seeds(spark):
    assert {n: dimensions.seed(spark, n).count() for n in dimensions.DIMENSIONS} == {"machines": 10, "machine_status": 3, "alarm_codes": 4, "operators": 10}
    assert dict(dimensions.seed(spark, "machine_status").dtypes) == {"status_id": "int", "status_name": "string"}


def test_range_predicates_cover_every_row_once(spark):
    rows = spark.createDataFrame([(dt.datetime(2024, 1, d),) for d in range(1, 11)] + [(None,)], "ts timestamp_ntz")
    predicates = tables.range_predicates("ts", tables.time_bounds("2024-01-01 00:00:00", "2024-01-11 00:00:00", 4))
    assert len(predicates) == 4 and sum(rows.where(p).count() for p in predicates) == 11
    assert tables.range_predicates("ts", []) == ["1 = 1"]


def test_a_measurement_is_pruned_by_folder(spark, tmp_path):
    rows = spark.createDataFrame([(1, "Machine_1", dt.datetime(2024, 1, 1), 1.0, "Idle", "None")],
                                 "event_id long, machine_id string, ts timestamp_ntz, power_kw double, machine_status string, alarm_code string")
    long = metrics.to_long({"scada": rows})
    metrics.write_long(long, str(tmp_path / "m"))
    back = metrics.in_range(spark.read.schema(long.schema).parquet(str(tmp_path / "m")), "scada_metrics", "power_kw", "2023-01-01 00:00:00")
    assert [r["value"] for r in back.collect()] == [1.0]
    assert "measurement" in back._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:120]


ROW = "ts timestamp_ntz, machine_id string, event_id long, v double"


def batch(spark, *rows):
    return spark.createDataFrame([(dt.datetime(2024, 1, d), m, e, v) for d, m, e, v in rows], ROW)


def test_upsert_takes_the_last_and_can_repeat(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert.upsert(batch(spark, (1, "a", 1, 1.0), (2, "a", 2, 2.0)), path)
    second = batch(spark, (2, "a", 3, 3.0), (2, "a", 4, 4.0), (3, "b", 5, 5.0))
    for _ in range(2):
        upsert.upsert(second, path)
    got = {(r["ts"].day, r["machine_id"]): r["v"] for r in upsert.read_table(spark, path, second.schema).collect()}
    assert got == {(1, "a"): 1.0, (2, "a"): 4.0, (3, "b"): 5.0}


def test_insert_takes_the_first_and_can_repeat(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert.insert_new(batch(spark, (1, "a", 1, 1.0), (1, "a", 2, 2.0)), path)
    second = batch(spark, (1, "a", 3, 3.0), (2, "a", 4, 4.0))
    for _ in range(2):
        upsert.insert_new(second, path)
    rows = upsert.read_table(spark, path, second.schema).collect()
    assert sorted((r["ts"].day, r["v"]) for r in rows) == [(1, 1.0), (2, 4.0)]


def test_published_fields_are_the_declared_ones(spark):
    rows = spark.createDataFrame([(dt.datetime(2024, 1, 1), "Machine_1", 1.0, "Idle", None)],
                                 "ts timestamp_ntz, machine_id string, power_kw double, machine_status string, alarm_code string")
    sent = json.loads(messages.publishable(rows, "scada").first()["value"])
    assert list(sent) == [f.name for f in schemas.SCADA_MESSAGE.fields] and sent["Alarm_Code"] == ""


def test_balanced_bounds_cut_crowded_times_evenly(spark):
    rows = spark.range(4000).selectExpr(
        "CASE WHEN id % 10 < 8 THEN timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id / 1000) "
        "WHEN id % 10 = 8 THEN timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(id % 300) END AS ts")
    text = rows.selectExpr("date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS ts").cache()
    bounds = tables.balanced_bounds(text, 8)
    assert len(bounds) == 7 and bounds == sorted(set(bounds))
    counts = [text.where(f"({p}) AND ts IS NOT NULL").count() for p in tables.range_predicates("ts", bounds)]
    assert sum(counts) == 3600 and max(counts) <= 1.1 * 3600 / 8
    assert sum(text.where(p).count() for p in tables.range_predicates("ts", bounds)) == 4000
    same = text.selectExpr("'2024-01-01 00:00:00' AS ts")
    assert len(tables.balanced_bounds(same, 8)) == 1
    assert tables.balanced_bounds(text.limit(0), 8) == [] and tables.balanced_bounds(text, 1) == []


def test_texts_that_are_no_time_are_flagged(spark):
    rows = spark.createDataFrame([("2024-01-31 10:00:00",), ("2024-02-31 10:00:00",), ("soon",), ("",), (None,)], "Timestamp string")
    found = tables.parsed_time(rows).collect()
    assert [r["is_rejected"] for r in found] == [False, True, True, True, False]
    assert [r["Timestamp"] is not None for r in found] == [True, False, False, False, False]
