"""Summarise the static physical plan of every registered query.

    python tools/plan_report.py [--sf DIR] > PLANS.md

Counts shuffles (hash / range / single-partition), broadcasts, exchange
reuse, partial top-n (WindowGroupLimit), global top-k, aggregates, joins, and
flags any Python node. AQE is switched off so the plan is the static one
(at runtime AQE may further coalesce partitions or turn joins into
broadcasts after measuring).
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                "PythonUDF")


def summarise(plan: str) -> dict[str, int | str]:
    return {
        "hash shuffles": len(re.findall(r"Exchange hashpartitioning", plan)),
        "range shuffles": len(re.findall(r"Exchange rangepartitioning", plan)),
        "single-partition": len(re.findall(r"Exchange SinglePartition", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "reused": plan.count("ReusedExchange"),
        "SMJ": plan.count("SortMergeJoin"),
        "BHJ": plan.count("BroadcastHashJoin"),
        "partial top-n": plan.count("WindowGroupLimit") // 2,
        "top-k": plan.count("TakeOrderedAndProject"),
        "python": "yes" if any(n in plan for n in PYTHON_NODES) else "no",
    }


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    args = ap.parse_args()
    from accounthealth.plans.registry import all_queries
    from accounthealth.plans.warehouse import Warehouse
    from accounthealth.session import local_session

    spark = local_session()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    wh = Warehouse.from_testdata(spark, args.sf)
    rows = []
    for key, q in all_queries().items():
        plan = q.build(wh)._jdf.queryExecution().executedPlan().toString()
        rows.append((key, summarise(plan)))
    cols = list(rows[0][1])
    print("# Static plans of the registered queries\n")
    print(f"Generated by `tools/plan_report.py --sf {args.sf}` (AQE off: the static plan).\n")
    print("| query | " + " | ".join(cols) + " |")
    print("| --- | " + " | ".join("---" for _ in cols) + " |")
    for key, s in rows:
        print(f"| {key} | " + " | ".join(str(s[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
