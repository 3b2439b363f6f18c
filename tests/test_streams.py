"""Streams over several small batches against their batch twins."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.checks import live, streams
from millrace.operators import affinity, align, fact
from millrace.operators import state as latest
from millrace.operators.asof import Feed, nearest_within
from millrace.operators.upsert import read_table
from millrace.plans import jobs, marts
from millrace.operators.scaling import Scaler
from millrace.sources import dimensions, events, messages, offsets
from millrace.streaming import load, runs
from millrace.streaming import state as kept
from millrace.streaming.classify import OnlineClassifier
from millrace.streaming.fusion import stream_matches
from millrace.streaming.nearest import stream_nearest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """The events in time order as three files, and a marker far in the future as the fourth."""
    folder = tmp_path_factory.mktemp("events")
    rows = events.read_events(spark, FOLDER)
    for low, high in (("2024-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2024-02-01")):
        part = rows.where(F.col("ts").between(F.lit(low).cast("timestamp_ntz"), F.lit(high).cast("timestamp_ntz") - F.expr("INTERVAL 1 MICROSECOND")))
        part.coalesce(1).write.mode("append").parquet(str(folder))
    marker = [(-1 - i, dt.datetime(2100, 1, 1), 0, kind, 0.0, '{"k": 99}') for i, kind in enumerate(("click", "error", "purchase"))]
    spark.createDataFrame(marker, events.EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))
    return str(folder)


def stream(spark, parts):
    return events.stream_events(spark, parts, "*.parquet", files_per_batch=1)


def topics(rows):
    return events.by_topic({name: view(rows) for name, view in events.FEEDS.items()})


def plain(rows, drop_marker=True):
    rows = rows.where("event_id >= 0") if drop_marker else rows
    return sorted(map(repr, streams.plain_time(rows).select(*sorted(rows.columns)).collect()))


def test_nearest_over_batches(spark, parts, tmp_path):
    rows = stream(spark, parts)
    iot = events.iot(rows).select("event_id", "machine_id", "ts")
    found = stream_nearest(iot, fact.mes_feed(events.mes(rows)), [])
    runs.replay(runs.to_table(found, str(tmp_path / "out")), spark, "nearest")
    source = events.read_events(spark, FOLDER)
    batch = nearest_within(events.iot(source).select("event_id", "machine_id", "ts"), [fact.mes_feed(events.mes(source))], ["machine_id"], matched_at=True)
    assert plain(spark.read.schema(found.schema).parquet(str(tmp_path / "out"))) == plain(batch)


def test_fact_load_over_batches(spark, parts, tmp_path):
    folder, table = str(tmp_path / "marts"), str(tmp_path / "fact")

    def refresh(since):
        if (tmp_path / "fact").exists():
            jobs.refresh_marts(spark.read.parquet(table), folder, since)

    loader = load.FactLoader(spark, str(tmp_path / "staging"), table, refresh)
    runs.replay(loader.writer(topics(stream(spark, parts))), spark, "load")
    kept_mart = spark.read.parquet(f"{folder}/units_month").select("machine_id", "units_produced")
    iot, scada, mes = (view(events.read_events(spark, FOLDER)) for view in (events.iot, events.scada, events.mes))
    want = fact.enrich(fact.fuse(iot, mes, scada), *streams._seeds(spark))
    schema = T.StructType([T.StructField(f.name, T.TimestampType()) if f.name == "ts" else f for f in want.schema.fields])
    got = read_table(spark, loader.table, schema).drop("day")
    assert plain(got, False) == plain(want, False)
    assert plain(kept_mart, False) == plain(marts.units(want, "month").select("machine_id", "units_produced"), False)
    before = got.count()
    loader.load(topics(events.read_events(spark, FOLDER).withColumn("ts", F.col("ts").cast("timestamp"))), 2)
    assert read_table(spark, loader.table, schema).count() == before


def test_rows_left_unsettled_load_after_a_gap(spark, tmp_path):
    """A later batch also loads what an earlier one had to leave, however far apart they are."""
    def event(event_id, ts, kind):
        return spark.createDataFrame([(event_id, ts, 0, kind, 0.0, '{"k": 50}')], events.EVENT_SCHEMA)

    def batch(*rows):
        out = rows[0]
        for r in rows[1:]:
            out = out.unionByName(r)
        return topics(out.withColumn("ts", F.col("ts").cast("timestamp")))

    loader = load.FactLoader(spark, str(tmp_path / "staging"), str(tmp_path / "fact"))
    loader.load(batch(event(1, dt.datetime(2024, 1, 1, 9, 50), "click"), event(2, dt.datetime(2024, 1, 1, 9, 55), "purchase")), 0)
    loader.load(batch(event(3, dt.datetime(2024, 1, 3, 20), "error")), 1)
    rows = spark.read.parquet(str(tmp_path / "fact")).collect()
    assert [(r["machine_id"], r["units_produced"]) for r in rows] == [(1, 52)]


def test_state_over_batches(spark, parts, tmp_path):
    snapshots = runs.Snapshots(spark, str(tmp_path / "state"), streams.STATE_SCHEMA)
    rows = topics(stream(spark, parts)).where("event_id >= 0")
    runs.replay(kept.keep_latest_state(rows, snapshots), spark, "state")
    assert plain(snapshots.latest(), False) == plain(latest.latest_state(topics(events.read_events(spark, FOLDER))), False)


def test_affinity_over_batches_and_a_repeated_batch(spark, parts, tmp_path):
    schema = T._parse_datatype_string(kept.AFFINITY_SCHEMA)
    snapshots = runs.Snapshots(spark, str(tmp_path / "affinity"), schema)
    mes = events.mes(stream(spark, parts)).where("event_id >= 0")
    runs.replay(kept.keep_affinity(mes, snapshots), spark, "affinity")
    want = {(r["operator_id"], r["machine_id"]): r["affinity"] for r in affinity.running(events.mes(events.read_events(spark, FOLDER))).collect()}

    def current():
        return {(r["operator_id"], r["machine_id"]): r["affinity"] for r in snapshots.latest().collect()}

    assert current() == pytest.approx(want)
    last = max(int(v) for v in runs.child_folders(spark, snapshots.path, "version"))
    value = snapshots.before(last)
    snapshots.write(value, last)
    assert len(current()) <= len(want)


def test_operators_over_batches(spark, parts, tmp_path):
    schema = T._parse_datatype_string("machine_id string, operator_id int, first_seen timestamp, records long")
    snapshots = runs.Snapshots(spark, str(tmp_path / "operators"), schema)
    runs.replay(kept.keep_operators(events.mes(stream(spark, parts)).where("event_id >= 0"), snapshots), spark, "operators")
    assert plain(snapshots.latest(), False) == plain(affinity.operators_of(events.mes(events.read_events(spark, FOLDER))), False)


def test_late_rows_drop_from_daily_units(spark, tmp_path):
    """A row older than the watermark of the batch before its own is not counted by the stream."""
    schema = events.EVENT_SCHEMA

    def write(event_id, ts):
        spark.createDataFrame([(event_id, ts, 0, "purchase", 0.0, '{"k": 1}')], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    write(1, dt.datetime(2024, 1, 1, 1))
    write(2, dt.datetime(2024, 1, 5, 1))
    write(5, dt.datetime(2024, 1, 5, 2))
    write(3, dt.datetime(2024, 1, 1, 2))
    write(4, dt.datetime(2024, 1, 9, 1))
    daily = load.daily_units(events.mes(events.stream_events(spark, str(tmp_path / "in"), "*.parquet", files_per_batch=1)))
    runs.replay(runs.to_table(daily, str(tmp_path / "out")), spark, "daily")
    found = {r["day"].day: r["units_produced"] for r in spark.read.schema(daily.schema).parquet(str(tmp_path / "out")).collect()}
    assert found == {1: 51, 5: 107}


def test_retraining_follows_the_message_count(spark, parts, tmp_path):
    counts = runs.Snapshots(spark, str(tmp_path / "counts"), load.COUNT_SCHEMA)
    fitted = []
    runs.replay(load.retrain_every(stream(spark, parts), counts, fitted.append, every=500), spark, "retrain")
    assert counts.latest().first()["seen"] == 1003 and len(fitted) == 2


def test_only_trigger_topics_score(spark, parts, tmp_path):
    schema = T._parse_datatype_string("machine_id string, ts timestamp, predicted double")
    scored = {}
    for name, triggers in (("all", ("iot", "scada", "mes")), ("none", ("other",))):
        state = runs.Snapshots(spark, str(tmp_path / name), streams.SCORED_SCHEMA)
        scores = runs.BatchFolders(spark, str(tmp_path / f"{name}-scores"), schema)
        rows = topics(stream(spark, parts))
        runs.replay(load.keep_scores(rows, state, scores, streams.POWER_INPUTS, streams.WEIGHTS, triggers=triggers), spark, name)
        scored[name] = scores.read().groupBy("batch").count().collect()
    assert len(scored["all"]) == 4 and scored["none"] == []


def test_fusion_over_batches_keeps_unmatched_and_drops_late_rows(spark, parts, tmp_path):
    rows = stream(spark, parts)
    columns = ["temperature_c", "vibration_mm_s", "pressure_bar"]
    found = stream_matches(events.iot(rows), [fact.mes_feed(events.mes(rows)), fact.scada_feed(events.scada(rows))], columns)
    runs.replay(runs.to_table(found, str(tmp_path / "out")), spark, "fuse")
    source = events.read_events(spark, FOLDER)
    feeds = [fact.mes_feed(events.mes(source)), fact.scada_feed(events.scada(source))]
    batch = nearest_within(events.iot(source), feeds, ["machine_id"])
    got = plain(spark.read.schema(found.schema).parquet(str(tmp_path / "out")))
    assert got == plain(batch) and any("power_kw=None" in r and "units_produced=None" in r for r in got)


def test_a_repeated_batch_leaves_the_classifier_as_it_is(spark, tmp_path):
    seeds = [dimensions.seed(spark, name) for name in ("machines", "machine_status", "alarm_codes")]
    scaler = Scaler({c: m for c, (m, _) in live.CENTRES.items()}, {c: s for c, (_, s) in live.CENTRES.items()})
    model = OnlineClassifier(spark, str(tmp_path), "machine_status", live.CLASSES["machine_status"], align.dimension_codes(*seeds), scaler)
    rows = topics(events.read_events(spark, FOLDER).withColumn("ts", F.col("ts").cast("timestamp")))
    early, late = rows.where("ts < '2024-01-15'"), rows.where("ts >= '2024-01-15'")
    model.step(early, 0)
    model.step(late, 1)
    once = [plain(x, False) for x in (model.weights.latest(), model.state.latest(), model.predictions.read())]
    model.step(late, 1)
    assert [plain(x, False) for x in (model.weights.latest(), model.state.latest(), model.predictions.read())] == once
    model.step(rows.limit(0), 2)
    assert plain(model.weights.latest(), False) == once[0]


def test_messages_of_all_topics_parse_in_one_pass(spark):
    good = '{"Timestamp":"2024-01-01 00:00:00","Machine_ID":"Machine_1","Power_Consumption_kW":1.5,"Machine_Status":"Idle","Alarm_Code":""}'
    rows = [("scada-data", 3, 7, good), ("scada-data", 3, 8, "{"), ("other", 0, 1, good), ("scada-data", 0, None, good), ("mes-data", 1, 2, None)]
    parsed = messages.parse_topics(spark.createDataFrame(rows, messages.RECORD)).collect()
    assert [r["is_rejected"] for r in parsed] == [False, True, True, True, True]
    assert (parsed[0]["topic"], parsed[0]["event_id"], parsed[0]["power_kw"], parsed[0]["alarm_code"]) == ("scada", 7 * 4096 + 3, 1.5, "None")


def test_gaps_across_blocks_and_partitions_without_records(spark):
    at = [0, 1, 5, 4095, 4096, 4100, 20_000, 20_000]
    records = spark.createDataFrame([("a", 0, x) for x in at] + [("a", 1, 9), ("a", 1, None)], "topic string, partition int, offset long")
    got = sorted(tuple(r) for r in offsets.gaps(records).collect())
    assert got == [("a", 0, 2, 4, 3), ("a", 0, 6, 4094, 4089), ("a", 0, 4097, 4099, 3), ("a", 0, 4101, 19_999, 15_899)]
    ends = spark.createDataFrame([("a", 0, 20_005), ("a", 1, 10), ("b", 0, 4)], "topic string, partition int, end_offset long")
    got = sorted(tuple(r) for r in offsets.ledger(records, ends).collect())
    assert got == [("a", 0, 0, 20_000, 8, 1, 20_001 - 7, 4), ("a", 1, 9, 9, 1, 0, 0, 0), ("b", 0, None, None, 0, 0, None, 4)]


def test_matches_on_a_stream_form_no_pairs_and_equal_brute_force(spark, tmp_path):
    """Crowded instants, copies, ties, rows at the tolerance and across slices, rows without machine; no join, so no pairs."""
    zero, draw = dt.datetime(2024, 1, 1), random.Random(7)
    machines = ["A", "B", None]
    sensor = [(i, draw.choice(machines), zero + dt.timedelta(seconds=draw.choice((draw.randrange(30_000), 900 * draw.randrange(30)))), 1.0) for i in range(400)]
    sensor += sensor[:20]
    offers = {
        name: [(i, draw.choice(machines), zero + dt.timedelta(seconds=900 * draw.randrange(30) + draw.choice((0, 0, 1, 450))), i) for i in range(count)]
        for name, count in (("near", 150), ("wide", 25))
    }
    offers["near"] += [(None, "A", zero + dt.timedelta(seconds=900 * k), 1000 + k) for k in range(0, 30, 4)]

    def arriving(rows, name, columns):
        kinds = f"event_id long, machine_id string, ts timestamp, {columns}"
        for part in (rows[: len(rows) // 2], [*rows[len(rows) // 2 :], (-1, "A", dt.datetime(2100, 1, 1), None)]):
            spark.createDataFrame(part, kinds).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        return spark.readStream.schema(kinds).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))

    left = arriving(sensor, "left", "t double")
    within = {"near": 900, "wide": 3600}
    feeds = [Feed(n, arriving(offers[n], n, f"{n}_no long"), within[n], [f"{n}_no"], "event_id") for n in within]

    def best(row, name):
        gaps = [(abs((at - row[2]).total_seconds()), at, tie is not None, tie, no) for tie, machine, at, no in offers[name] if machine is not None and machine == row[1]]
        gaps = [g for g in gaps if g[0] <= within[name]]
        return min(gaps, key=lambda g: (*g[:3], g[3] or 0))[4] if gaps else None

    for number, used in enumerate(([feeds[0]], feeds)):
        found = stream_matches(left, used, ["t"]) if number else stream_nearest(left, used[0], ["t"])
        assert "Join" not in found._jdf.queryExecution().analyzed().toString()
        out = str(tmp_path / f"out-{number}")
        runs.replay(runs.to_table(found, out), spark, "matches")
        rows = spark.read.schema(found.schema).parquet(out).where("event_id >= 0").collect()
        got = sorted((r["event_id"], *[r[f"{f.name}_no"] for f in used]) for r in rows)
        assert got == sorted({(r[0], *[best(r, f.name) for f in used]) for r in sensor})


def test_the_log_is_numbered_once_for_all_parts(spark, monkeypatch):
    """The parts that arrive are read from the written log; none numbers all messages again."""
    plans = []
    monkeypatch.setattr(messages, "write_record_files", lambda part, path: plans.append(part._jdf.queryExecution().analyzed().toString()))
    monkeypatch.setattr(messages, "record_files", lambda *given: None)
    monkeypatch.setattr(live.live, "run", lambda *given: None)
    live._piped(spark, FOLDER)
    assert len(plans) == 5 and not any("Window" in p for p in plans)
