"""The batch job writes every output."""

import glob
import json

from accounthealth import jobs
from accounthealth.plans.warehouse import MODEL_NAMES, Warehouse
from accounthealth.sources import sinks


def test_publish_writes_all_outputs(spark, tmp_path):
    wh = Warehouse.from_testdata(spark, "/root/testdata/sf0.001")
    out = str(tmp_path / "run")
    made = jobs.publish(wh, out).collect()
    manifest = {r["table"]: r["rows"] for r in made}
    assert set(manifest) == set(MODEL_NAMES) and manifest["mart_churn_risk"] == 150
    for r in made:
        assert r["path"].startswith(f"{out}/warehouse/") and glob.glob(f"{r['path']}/*.parquet")
    audit = json.loads(open(glob.glob(f"{out}/quality_audit/part-*.json")[0]).read())
    assert audit["summary"]["total_checks"] == 10
    kpis = [json.loads(x) for f in glob.glob(f"{out}/readout/kpis/part-*.json") for x in open(f)]
    assert kpis[0]["accounts"] == 150
    (summary_file,) = glob.glob(f"{out}/workspace/summary/part-*.json")
    summary = json.loads(open(summary_file).read())
    assert set(summary) == {"kpis", "segments", "lifecycle", "adoption", "retention", "quality",
                            "source_coverage"}
    assert summary["kpis"]["accounts"] == 150
    revenue = [s["recognized_revenue"] for s in summary["segments"]]
    assert len(revenue) == 3 and revenue == sorted(revenue, reverse=True)
    assert len(summary["source_coverage"]) == 8
    assert summary["source_coverage"][0]["source"] == "CRM accounts"
    assert summary["quality"]["summary"]["total_checks"] == 10
    accounts = [x for f in glob.glob(f"{out}/workspace/accounts/segment=*/part-*.json")
                for x in open(f)]
    assert len(accounts) == 150
    lines = [x for f in glob.glob(f"{out}/queue_export/part-*.csv") for x in open(f)]
    assert len([x for x in lines if not x.startswith('"account_id"')]) == 150


def test_publish_from_a_previous_build(spark, tmp_path):
    wh = Warehouse.from_testdata(spark, "/root/testdata/sf0.001")
    first = str(tmp_path / "first")
    jobs.publish(wh, first).collect()
    built = sinks.read_built(spark, f"{first}/warehouse", wh.sources)
    assert "FileScan" in built.table("mart_churn_risk")._jdf.queryExecution() \
        .executedPlan().toString()
    second = str(tmp_path / "second")
    assert jobs.publish(built, second, build=False) is None
    a = sorted(open(f).read() for f in glob.glob(f"{first}/queue_export/part-*.csv"))
    b = sorted(open(f).read() for f in glob.glob(f"{second}/queue_export/part-*.csv"))
    assert "".join(a) == "".join(b)
