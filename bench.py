"""Benchmark the pipeline: build the warehouse, then run the reports over it.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

This is the reference workflow: every model is built once as a written table
(``build_warehouse``: the 21 models in build order, each re-read by the
models after it), then the audit, readout, workspace and queue queries run
over the built tables. ``mart_churn_risk_cold`` times the flagship query from
the raw sources alone. Each timed query is executed in full with the ``noop``
sink (all rows computed, nothing collected). Prints one JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.
``BENCH_ALL=1`` times every registered query from the raw sources instead.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

REPORTS = [
    "dq_audit",
    "rpt_kpis",
    "rpt_top_risk",
    "rpt_retention",
    "ws_queue",
    "ws_segments",
    "ws_recent_events",
    "ws_usage_trend",
    "ws_account_detail",
    "app_queue_page",
    "app_queue_export",
    "app_account_brief",
]


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from accounthealth.plans.registry import all_queries
    from accounthealth.plans.warehouse import Warehouse
    from accounthealth.session import ensure_checkpoint_dir, local_session
    from accounthealth.sources.sinks import write_tables

    spark = local_session(cpus=cpus, shuffle_partitions=4 * cpus, app="accounthealth-bench")
    queries = all_queries()

    # Warm the JVM (class loading, codegen caches) on the smallest tables.
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        _run(queries["mart_churn_risk"].run(spark, warm))

    times: dict[str, float] = {}
    if os.environ.get("BENCH_ALL"):
        for key, q in queries.items():
            t0 = time.perf_counter()
            _run(q.run(spark, sf_dir))
            times[key] = round(time.perf_counter() - t0, 3)
        metric = "all_queries_cold_total"
    else:
        t0 = time.perf_counter()
        _run(queries["mart_churn_risk"].run(spark, sf_dir))
        times["mart_churn_risk_cold"] = round(time.perf_counter() - t0, 3)

        out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bench-{uuid.uuid4().hex[:8]}"
        wh = Warehouse.from_testdata(spark, sf_dir)
        t0 = time.perf_counter()
        write_tables(wh, out).collect()
        times["build_warehouse"] = round(time.perf_counter() - t0, 3)

        for key in REPORTS:
            t0 = time.perf_counter()
            _run(queries[key].build(wh))
            times[key] = round(time.perf_counter() - t0, 3)
        metric = "pipeline_total"

    match = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": metric,
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(match.group(1)) if match else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
