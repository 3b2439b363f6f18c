"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores (8).
Every query runs once to warm up and is then timed as the best of BENCH_RUNS (2) full evaluations;
results go to the no-op sink, so all rows and columns are computed.
"""

from __future__ import annotations

import json
import os
import time

from millrace import checks
from millrace.session import local_session, prepare

HEADLINE = [
    "nearest_mes", "nearest_scada", "fuse_streams", "enrich_fact", "units_day", "failures_week", "efficiency_day",
    "efficiency_month", "power_day", "plant_power_month", "align_outer3", "ffill_machine", "features_units",
    "affinity_batch", "affinity_running", "optimal_pairings", "latest_state", "energy_per_unit_asof", "energy_anomalies",
    "energy_efficiency", "latest_metric", "sink_long_metrics", "auc_ovr", "cluster_power_quantiles", "performance_analysis",
    "energy_forecast", "sgd_step", "dbscan_core",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = prepare(local_session(os.environ.get("BENCH_CPUS", "8"), "millrace-bench"))
    spark.sparkContext.setLogLevel("ERROR")
    queries, times = checks.queries(), {}
    for name in HEADLINE:
        runs = []
        for _ in range(1 + int(os.environ.get("BENCH_RUNS", "2"))):
            begin = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - begin)
        times[name] = round(min(runs[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
