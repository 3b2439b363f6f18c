import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from millrace.operators.sessions import SESSION, sessions, stream_sessions
from millrace.streaming import runs

T0 = dt.datetime(2024, 1, 1, 8)
ROWS = "machine_id string, ts timestamp"


def events(spark):
    draw = np.random.default_rng(4)
    rows = [(m, T0 + dt.timedelta(seconds=int(s))) for m, n in (("hot", 300), ("cold", 20), (None, 5)) for s in draw.integers(0, 200_000, n)]
    rows += [("edge", T0), ("edge", T0 + dt.timedelta(seconds=600)), ("edge", T0 + dt.timedelta(seconds=1199)), ("edge", T0 + dt.timedelta(seconds=1800))]
    return rows + rows[:30] + [("hot", None)]


def by_hand(rows, pause):
    out, known = [], sorted({m for m, _ in rows}, key=str)
    for machine in known:
        current = None
        for t in sorted(t for m, t in rows if m == machine and t):
            if current and (t - current[2]).total_seconds() <= pause:
                current[2], current[3] = t, current[3] + 1
            else:
                current = [machine, t, t, 1]
                out.append(current)
    return sorted(map(tuple, out), key=str)


def test_sessions_equal_a_walk_and_the_built_in_window(spark):
    rows = events(spark)
    frame = spark.createDataFrame(rows, ROWS)
    found = sorted((tuple(r) for r in sessions(frame, 600).select("machine_id", "started", "ended", "events").collect()), key=str)
    window = frame.groupBy("machine_id", F.session_window("ts", "600 seconds")).agg(F.min("ts"), F.max("ts"), F.count("*"))
    assert found == sorted((tuple(r) for r in window.drop("session_window").collect()), key=str)
    assert found == by_hand(rows, 600)


def test_sessions_of_an_empty_table(spark):
    assert sessions(spark.createDataFrame([], ROWS)).collect() == []


def test_streamed_sessions_over_several_batches(spark, tmp_path):
    rows = sorted([r for r in events(spark) if r[0] and r[1]], key=lambda r: r[1])
    parts = np.array_split(np.arange(len(rows)), 4)
    for i, part in enumerate([*parts, None]):
        batch = [("closing", T0 + dt.timedelta(days=99))] if part is None else [rows[j] for j in part]
        spark.createDataFrame(batch, ROWS).coalesce(1).write.mode("append").parquet(str(tmp_path / f"in/p{i}"))
    stream = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    runs.replay(runs.to_table(stream_sessions(stream, 600), str(tmp_path / "out")), spark, "sessions")
    found = [tuple(r) for r in spark.read.schema(SESSION).parquet(str(tmp_path / "out")).collect()]
    assert sorted(found, key=str) == by_hand(rows, 600)
