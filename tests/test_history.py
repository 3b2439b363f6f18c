import datetime as dt

import numpy as np

from millrace.streaming import runs
from millrace.streaming.history import keep_history, read_history
from millrace.streaming.load import TOPIC_SCHEMA

T0 = dt.datetime(2024, 1, 1, 8)
NAMES = [f.name for f in TOPIC_SCHEMA.fields]


def record(i, machine, second, power=None):
    row = dict.fromkeys(NAMES) | {"event_id": i, "machine_id": machine, "topic": "scada", "power_kw": power, "alarm_code": "" if i % 2 else None}
    row["ts"] = None if second is None else T0 + dt.timedelta(seconds=second, microseconds=i % 7)
    return tuple(row[n] for n in NAMES)


def test_history_keeps_the_newest_over_many_runs_late_rows_and_ties(spark, tmp_path):
    draw = np.random.default_rng(2)
    rows = [record(i, "hot" if i % 3 else f"m{i % 5}", int(draw.integers(0, 500)), i / 3 if i % 4 else None) for i in range(900)]
    rows += [record(1000, None, 1), record(1001, "hot", None), record(1002, "one", 5, 0.1)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        for part in np.array_split(np.arange(len(rows)), 5):
            spark.createDataFrame([rows[i] for i in part], TOPIC_SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            stream = spark.readStream.schema(TOPIC_SCHEMA).parquet(str(tmp_path / "in"))
            runs.resume(keep_history(stream, records=10, slots=4), str(tmp_path / "state"))
        found = read_history(spark, str(tmp_path / "state"), 10).collect()
        raw = spark.read.format("statestore").option("stateVarName", "entries").load(str(tmp_path / "state/checkpoint"))
        held = {(r["machine_id"], r["slot"]): r["count"] for r in raw.groupBy("key.machine_id", "key.slot").count().collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want, at = set(), {n: k for k, n in enumerate(NAMES)}
    for machine in {r[at["machine_id"]] for r in rows} - {None}:
        mine = [r for r in rows if r[at["machine_id"]] == machine and r[at["ts"]]]
        mine.sort(key=lambda r: (r[at["ts"]], r[at["event_id"]]), reverse=True)
        want |= {(*r, age) for age, r in enumerate(mine[:10], 1)}
    assert {tuple(r[n] for n in [*NAMES, "age"]) for r in found} == want and len(found) == len(want)
    assert max(held.values()) == 10 and len({s for m, s in held if m == "hot"}) == 4


def test_history_of_silent_machines_goes(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        spark.createDataFrame([record(1, "a", 1, 2.5)], TOPIC_SCHEMA).write.parquet(str(tmp_path / "in"))
        for folder, silent in (("long", dt.timedelta(days=1)), ("short", dt.timedelta(milliseconds=1))):
            stream = spark.readStream.schema(TOPIC_SCHEMA).parquet(str(tmp_path / "in"))
            runs.resume(keep_history(stream, silent=silent), str(tmp_path / folder))
        assert [tuple(r) for r in read_history(spark, str(tmp_path / "long")).select("machine_id", "power_kw").collect()] == [("a", 2.5)]
        assert read_history(spark, str(tmp_path / "short")).count() == 0
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", before)
