"""Time the headline queries; print one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPS (default 3). Each query is executed to completion with the
``noop`` sink (no collect), once to warm up and then BENCH_REPS times; the
median is reported. ``run_metrics`` (the whole event-lake run, with its
Parquet writes) is warmed up once and then timed once.

With BENCH_EVENTLOG=1, shuffle bytes per query (average per run) are added
from Spark's event log, written to a fresh scratch folder: every run is
tagged with a job group and the ``Shuffle Bytes Written`` of its tasks are
summed. Off by default so the listener does not add to the timings.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time
from collections import defaultdict

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "filter_activity", "route_events", "routing_coverage", "ad_preagg_output",
    "validate_files", "processing_stats", "dlq_summary", "dedupe_latest", "content_checks",
    "csv_scan", "file_isolation",
]
ONCE = ["run_metrics"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    from ebbflow.session import build_session
    from ebbflow.plans import catalog, exports

    log_dir = tempfile.mkdtemp(prefix="ebbflow-bench-events-") if os.environ.get("BENCH_EVENTLOG") == "1" else None
    extra = {} if log_dir is None else {
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}",
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"}
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), extra=extra)
    t = time.perf_counter()
    exports.export_root(spark, sf_dir)  # source files for the scan queries (not timed)
    setup = time.perf_counter() - t

    runs: dict[str, int] = defaultdict(int)

    def run(name: str) -> float:
        runs[name] += 1
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    times: dict[str, float] = {}
    for name in HEADLINE:
        run(name)
        times[name] = round(statistics.median(run(name) for _ in range(reps)), 3)
    for name in ONCE:
        run(name)
        times[name] = round(run(name), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    spark.stop()
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "cpus": cpus,
        "export_setup_sec": round(setup, 3),
    }
    if log_dir is not None:
        out["shuffle_bytes"] = shuffle_bytes(log_dir, runs)
    print(json.dumps(out))


def shuffle_bytes(log_dir: str, runs: dict[str, int]) -> dict[str, int]:
    """Average shuffle bytes written per run of each job group."""
    stage_group: dict[int, str] = {}
    total: dict[str, int] = defaultdict(int)
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    metrics = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    if group:
                        total[group] += int(metrics.get("Shuffle Bytes Written", 0))
    return {k: total.get(k, 0) // max(1, n) for k, n in runs.items()}


if __name__ == "__main__":
    main()
