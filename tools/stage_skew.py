"""Per-stage task skew from Spark's event log (no UI, no server).

    python tools/stage_skew.py [--sf DIR] [key ...]

Runs the given registered queries with the event log written to a fresh
scratch folder, then reads the log and prints, per stage: task count, max and
median task time, and max and median shuffle-read records. A stage whose max
is far above its median holds a hot partition.
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(log_path: str) -> list[dict]:
    tasks: dict[tuple[int, int], list[tuple[int, int]]] = {}
    names: dict[tuple[int, int], str] = {}
    files = sorted(glob.glob(f"{log_path}/events_*")) if os.path.isdir(log_path) else [log_path]
    for path in files:
        for line in open(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                names[(info["Stage ID"], info["Stage Attempt ID"])] = info["Stage Name"]
            elif kind == "SparkListenerTaskEnd" and ev.get("Task Metrics"):
                key = (ev["Stage ID"], ev["Stage Attempt ID"])
                m = ev["Task Metrics"]
                read = m.get("Shuffle Read Metrics", {})
                recs = read.get("Total Records Read", 0)
                tasks.setdefault(key, []).append((m.get("Executor Run Time", 0), recs))
    out = []
    for key, values in sorted(tasks.items()):
        times = [t for t, _ in values]
        recs = [r for _, r in values]
        out.append({
            "stage": key[0], "tasks": len(values), "name": names.get(key, "")[:40],
            "max_ms": max(times), "median_ms": statistics.median(times),
            "max_read": max(recs), "median_read": statistics.median(recs),
        })
    return out


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("keys", nargs="*", default=["ws_recent_events", "fct_product_usage_daily"])
    args = ap.parse_args()
    from pyspark.sql import SparkSession

    from accounthealth.plans.registry import all_queries
    from accounthealth.session import SQL_DEFAULTS

    log_dir = tempfile.mkdtemp(prefix="eventlog-", dir="/tmp")
    builder = (SparkSession.builder.master("local[8]").appName("stage-skew")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.eventLog.enabled", "true")
               .config("spark.eventLog.dir", log_dir)
               .config("spark.eventLog.compress", "false")
               .config("spark.sql.shuffle.partitions", "32"))
    for k, v in SQL_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    for key in args.keys:
        spark.sparkContext.setJobDescription(key)
        queries[key].run(spark, args.sf).write.format("noop").mode("overwrite").save()
    spark.stop()
    (log,) = glob.glob(f"{log_dir}/*")
    print(f"{'stage':>5} {'tasks':>5} {'max_ms':>7} {'med_ms':>7} {'max_read':>9} "
          f"{'med_read':>9}  name")
    for s in summarise(log):
        print(f"{s['stage']:>5} {s['tasks']:>5} {s['max_ms']:>7} {s['median_ms']:>7.0f} "
              f"{s['max_read']:>9} {s['median_read']:>9.0f}  {s['name']}")


if __name__ == "__main__":
    main()
