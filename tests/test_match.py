import datetime as dt
import random

import pytest

from millrace.operators import asof, fact

START = dt.datetime(2024, 1, 1)
IOT = "event_id long, machine_id string, ts timestamp_ntz"
MES = "event_id long, machine_id string, ts timestamp_ntz, operator_id int, units_produced int, defective_units int, production_time_min double"
SCADA = "event_id long, machine_id string, ts timestamp_ntz, power_kw double, machine_status string, alarm_code string"


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def iot(spark, *seconds, machine="Machine_1"):
    return spark.createDataFrame([(i, machine, at(s)) for i, s in enumerate(seconds)], IOT)


def mes(spark, *rows, machine="Machine_1"):
    return spark.createDataFrame([(i, machine, at(s), 1000, units, 1, 10.0) for i, (s, units) in enumerate(rows)], MES)


def units(left, right, **options):
    found = asof.nearest_within(left, [fact.mes_feed(right)], ["machine_id"], **options)
    return {r["event_id"]: r["units_produced"] for r in found.collect()}


def test_a_tie_takes_the_earlier_row(spark):
    assert units(iot(spark, 1800), mes(spark, (3600, 2), (0, 1))) == {0: 1}


def test_the_tolerance_is_inclusive(spark):
    assert units(iot(spark, 0), mes(spark, (3600, 1))) == {0: 1}
    assert units(iot(spark, 0), mes(spark, (3601, 1))) == {0: None}
    assert units(iot(spark, 7200), mes(spark, (3600, 1))) == {0: 1}


def test_the_scada_tolerance(spark):
    rows = spark.createDataFrame([(1, "Machine_1", at(900), 150.0, "Running", ""), (2, "Machine_2", at(901), 1.0, "Idle", "")], SCADA)
    left = iot(spark, 0).unionByName(iot(spark, 0, machine="Machine_2"))
    fused = {r["machine_id"]: (r["power_kw"], r["alarm_code"]) for r in fact.fuse(left, scada=rows).collect()}
    assert fused == {"Machine_1": (150.0, "None"), "Machine_2": (None, None)}


def test_unmatched_rows_stay_unless_required(spark):
    left, right = iot(spark, 0, 100_000), mes(spark, (10, 7))
    assert units(left, right) == {0: 7, 1: None}
    assert units(left, right, required=["mes"]) == {0: 7}


def test_other_machines_do_not_match(spark):
    assert units(iot(spark, 0), mes(spark, (0, 1), machine="Machine_2")) == {0: None}


def test_rows_without_machine_or_time_stay_unmatched(spark):
    left = spark.createDataFrame([(0, None, at(0)), (1, "Machine_1", None), (2, "Machine_1", at(0))], IOT)
    assert units(left, mes(spark, (0, 5))) == {0: None, 1: None, 2: 5}


def test_copies_of_an_instant(spark):
    """Copies on the left all match; of copies on the right the smallest id wins."""
    left = spark.createDataFrame([(i, "Machine_1", at(50)) for i in range(200)], IOT)
    right = spark.createDataFrame([(i, "Machine_1", at(60), 1000, i, 0, 1.0) for i in range(5, 300)], MES)
    assert units(left, right) == {i: 5 for i in range(200)}


@pytest.mark.parametrize("slice_s", [None, 60, 1000, 7200])
def test_agrees_with_the_ranking_form(spark, slice_s):
    """Random rows with a hot machine, ties and repeated instants, for several slice widths."""
    draw = random.Random(7)

    def rows(n, span):
        return [(i, "Machine_1" if draw.random() < 0.4 else f"Machine_{draw.randint(1, 5)}", at(draw.randrange(0, span, 450))) for i in range(n)]

    left = spark.createDataFrame(rows(400, 200_000), IOT)
    right = spark.createDataFrame([(*r, 1000, r[0], 0, 1.0) for r in rows(120, 200_000)], MES)
    feed = fact.mes_feed(right)
    ranked = {r["event_id"]: r["units_produced"] for r in asof.nearest_by_rank(left, feed, ["machine_id"], "event_id").collect()}
    expected = {i: ranked.get(i) for i in range(400)}
    assert units(left, right, slice_s=slice_s) == expected
    assert len(ranked) > 100


def test_dimension_joins(spark):
    from millrace.sources import dimensions

    states, alarms = dimensions.seed(spark, "machine_status"), dimensions.seed(spark, "alarm_codes")
    schema = SCADA + ", temperature_c double, vibration_mm_s double, pressure_bar double, operator_id int, units_produced int, defective_units int, production_time_min double"
    rows = [
        (1, "Machine_10", at(0), 1.0, "Idle", "Overheat", *[1.0] * 3, 1000, 1, 0, 1.0),
        (2, "Machine", at(1), 1.0, "Paused", "Smoke", *[1.0] * 3, None, 1, 0, 1.0),
    ]
    frame = spark.createDataFrame(rows, schema)
    found = {r["ts"]: (r["machine_id"], r["machine_status_id"], r["machine_status"], r["alarm_id"], r["alarm_code"], r["operator_id"])
             for r in fact.enrich(frame, states, alarms).collect()}
    assert found == {at(0): (10, 2, "Idle", 3, "Overheat", "1000"), at(1): (None, None, None, None, "Smoke", None)}
    machines = dimensions.seed(spark, "machines")
    assert [r["machine_no"] for r in fact.resolve_scada(frame, machines, states, alarms).collect()] == [10]


def joined_rows(spark, frame):
    """The most rows that a join of ``frame`` gives out."""
    def of(node):
        below, children = [], node.children()
        for i in range(children.size()):
            below += of(children.apply(i))
        counted = node.metrics().get("numOutputRows")
        return below + ([counted.get().value()] if "Join" in node.nodeName() and counted.isDefined() else [])

    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = frame.collect()
        return rows, max(of(frame._jdf.queryExecution().executedPlan()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_the_ranking_form_has_two_candidates_a_row_however_dense_the_feed(spark):
    left, right = iot(spark, *range(0, 900, 3)), mes(spark, *[(s, s) for s in range(0, 900, 2)])
    rows, most = joined_rows(spark, asof.nearest_by_rank(left, fact.mes_feed(right), ["machine_id"], "event_id"))
    assert {r["event_id"]: r["units_produced"] for r in rows} == {i: 3 * i - 3 * i % 2 for i in range(300)}
    assert most <= 2 * 300


def test_the_ranking_form_at_the_tolerance_with_copies_and_missing_keys(spark):
    left = spark.createDataFrame([(0, "A", at(3600)), (0, "A", at(3600)), (1, "A", at(7201)), (2, None, at(0)), (3, "A", None), (4, "B", at(0)), (5, "A", at(1800))], IOT)
    row = [1000, 1, 10.0]
    right = spark.createDataFrame(
        [(3, "A", at(0), 1000, 3, *row[1:]), (2, "A", at(0), 1000, 2, *row[1:]), (None, "A", at(3600), 1000, 4, *row[1:]), (1, "A", at(3600), 1000, 1, *row[1:]), (9, None, at(0), 1000, 9, *row[1:])], MES)
    found = asof.nearest_by_rank(left, fact.mes_feed(right), ["machine_id"], "event_id").collect()
    assert sorted((r["event_id"], r["units_produced"]) for r in found) == [(0, 4), (5, 2)]
