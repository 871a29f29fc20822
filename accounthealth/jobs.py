"""Batch job: build the warehouse and publish every output.

    spark-submit -m accounthealth --csv-dir s3://bucket/raw --out s3://bucket/run-42
    python -m accounthealth --parquet-dir /root/testdata/sf0.01 --out /tmp/run
    python -m accounthealth --csv-dir RAW --built /tmp/run/warehouse --out /tmp/run2

Outputs under ``--out`` (every one a distributed write):

    warehouse/builds/<build>/    the 21 models (parquet), built in order
    warehouse/published/         the published builds; readers take the latest
    quality_audit/               audit document (JSON)
    readout/<name>/              KPIs, top risk, retention listing (JSON lines)
    workspace/summary/           one document: kpis, segments, lifecycle, adoption,
                                 retention, quality, source coverage
    workspace/accounts/          per-account detail documents (JSON lines by segment)
    queue_export/                the attention queue as CSV
"""

from __future__ import annotations

import argparse

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

from accounthealth.operators import explorer, quality, reports
from accounthealth.operators import workspace as ws
from accounthealth.plans.warehouse import Warehouse
from accounthealth.session import configure
from accounthealth.sources import column_types, sinks
from accounthealth.sources.schemas import SOURCE_NAMES


def _json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def publish(wh: Warehouse, out: str, buckets: int | None = None,
            build: bool = True) -> DataFrame | None:
    """Build every model as a table, then write all outputs from the built
    tables (bucketed on ``account_id`` when ``buckets`` is set). With
    ``build=False`` the warehouse is already bound to a previous build
    (``sinks.read_built``) and only the outputs are written. Returns the
    build manifest when it builds."""
    out = out.rstrip("/")
    manifest = sinks.write_tables(wh, f"{out}/warehouse", buckets=buckets) if build else None
    audit = quality.audit(wh)
    sinks.write_audit_json(audit, f"{out}/quality_audit")
    scored = wh.table("scored_accounts")
    _json(reports.kpis(scored), f"{out}/readout/kpis")
    _json(reports.top_risk(scored), f"{out}/readout/top_risk")
    _json(reports.retention_listing(wh.table("mart_revenue_retention")), f"{out}/readout/retention")
    _json(reports.health_by_segment(scored), f"{out}/readout/health_by_segment")
    _json(reports.churn_histogram(scored), f"{out}/readout/churn_histogram")
    _json(reports.retention_series(wh.table("mart_revenue_retention")),
          f"{out}/readout/retention_series")
    _json(reports.adoption_top(wh.table("mart_product_adoption")), f"{out}/readout/adoption_top")
    _json(ws.json_safe(ws.ordered_queue(wh)), f"{out}/workspace/queue")
    _json(ws.summary_document(wh, audit).coalesce(1), f"{out}/workspace/summary")
    sinks.write_account_details(ws.account_detail(wh), f"{out}/workspace/accounts")
    sinks.write_queue_csv(explorer.export_rows(wh), f"{out}/queue_export")
    return manifest


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="accounthealth")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--csv-dir", help="folder with <source>.csv files")
    src.add_argument("--parquet-dir", help="folder with the TPC-H-like parquet tables")
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--built", default=None,
                    help="warehouse folder of a previous build: publish from it, no rebuild")
    ap.add_argument("--buckets", type=int, default=None,
                    help="bucket the account-keyed models on account_id into this many buckets")
    ap.add_argument("--check-types", action="store_true",
                    help="report the column types first; stop if a value would fail the build")
    args = ap.parse_args(argv)
    builder = SparkSession.builder.appName("accounthealth")
    if not SparkConf().contains("spark.ui.enabled"):
        builder = builder.config("spark.ui.enabled", "false")   # batch job: no web UI
    spark = configure(builder.getOrCreate())
    wh = (Warehouse.from_csv(spark, args.csv_dir) if args.csv_dir
          else Warehouse.from_testdata(spark, args.parquet_dir))
    if args.check_types:
        found = column_types.report({name: wh.raw(name) for name in SOURCE_NAMES}).collect()
        for r in found:  # one row a column of the eight sources
            print(f"{r.source}.{r['column']}: {r.found}, {r.missing} missing")
        bad = [r for r in found if r.bad and (r.source, r["column"]) not in column_types.LENIENT]
        if bad:
            raise SystemExit("\n".join(
                f"{r.source}.{r['column']}: {r.bad} values are no {r.expected}, as {r.example!r}"
                for r in bad))
    if args.built:
        publish(sinks.read_built(spark, args.built, wh.sources), args.out, build=False)
        return
    publish(wh, args.out, args.buckets).orderBy("table").show(30, truncate=False)
