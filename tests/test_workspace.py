"""Workspace: queue order, reasons, lists, detail document and sinks."""

import csv
import glob
import json

from pyspark.sql import functions as F

from accounthealth.operators import explorer as ex
from accounthealth.operators import quality
from accounthealth.operators import workspace as ws
from accounthealth.sources import sinks


def test_queue_order_is_risk_then_revenue(wh_small):
    rows = ws.ordered_queue(wh_small).collect()
    keys = [(-r["churn_risk_score"], -r["recognized_revenue"], r["account_id"]) for r in rows]
    assert keys == sorted(keys) and len(rows) == 150


def test_reasons_bounded_and_primary(wh_small):
    for r in ws.attention_queue(wh_small).collect():
        reasons = r["attention_reasons"]
        assert 1 <= len(reasons) <= 4
        assert r["primary_reason"] == reasons[0]["label"]
        if r["lifecycle_stage"] == "churned":
            assert reasons[0]["label"] == "Lifecycle is churned"
        if r["failed_invoice_amount"] > 0:
            assert any(x["label"] == "Billing needs review" for x in reasons)


def test_record_lists_respect_limits(wh_mid):
    for name, (_, _, limit) in ws.RECORD_LISTS.items():
        if limit:
            top = ws.record_list(wh_mid, name).groupBy("account_id").count() \
                .agg(F.max("count")).first()[0]
            assert top <= limit, name


def test_trends_one_row_per_month(wh_small):
    t = ws.record_list(wh_small, "revenue")
    assert t.count() == t.select("account_id", "month").distinct().count()


def test_detail_document_and_json_sink(wh_small, tmp_path):
    detail = ws.account_detail(wh_small)
    assert detail.count() == 150
    out = str(tmp_path / "details")
    sinks.write_account_details(detail, out)
    lines = [json.loads(line) for f in glob.glob(out + "/segment=*/part-*.json")
             for line in open(f)]
    assert len(lines) == 150
    doc = lines[0]
    assert set(doc["records"]) == {"crm", "customer", "invoices", "support", "product",
                                   "opportunities"}
    assert set(doc["trends"]) == {"usage", "revenue", "support"}
    assert "plan" in doc["account"]          # nulls written, not dropped
    assert all(r["account_id"] == doc["account_id"] for r in doc["records"]["invoices"])
    for d in lines:
        assert len(d["records"]["invoices"]) <= 8 and len(d["adoption"]) <= 12
        dates = [i["invoice_date"] for i in d["records"]["invoices"]]
        assert dates == sorted(dates, reverse=True)


def test_audit_json_sink(wh_small, tmp_path):
    out = str(tmp_path / "audit")
    sinks.write_audit_json(quality.audit(wh_small), out)
    files = glob.glob(out + "/part-*.json")
    assert len(files) == 1
    doc = json.loads(open(files[0]).read())
    assert doc["summary"]["total_checks"] == 10
    assert [c["name"] for c in doc["checks"]][0] == "duplicate_crm_accounts"


def test_queue_csv_sink(wh_small, tmp_path):
    out = str(tmp_path / "queue")
    export = ex.export_rows(wh_small)
    sinks.write_queue_csv(export, out, single_file=True)
    (path,) = glob.glob(out + "/part-*.csv")
    raw = open(path, newline="").read()
    assert raw.startswith('"account_id","account_name","segment"')
    assert raw.endswith("\n") and "\r" not in raw
    rows = list(csv.reader(raw.splitlines()))
    assert rows[0] == ex.EXPORT_COLUMNS and len(rows) == 151
    # every field quoted, whole numbers without a trailing .0
    assert all(line.startswith('"') and line.endswith('"') for line in raw.splitlines())
    assert not any(v.endswith(".0") for r in rows[1:] for v in r[6:9])


def test_tables_sink_rebinds_models(spark, tmp_path):
    from accounthealth.plans.warehouse import Warehouse

    wh = Warehouse.from_testdata(spark, "/root/testdata/sf0.001")
    manifest = sinks.write_tables(wh, str(tmp_path / "wh"),
                                  ["dim_accounts", "mart_customer_health", "mart_churn_risk"])
    got = {r["table"]: r["rows"] for r in manifest.collect()}
    assert got == {"dim_accounts": 150, "mart_customer_health": 150, "mart_churn_risk": 150}
    assert "FileScan" in wh.table("mart_churn_risk")._jdf.queryExecution().executedPlan() \
        .toString()


def test_lists_are_nested_alike_from_buckets(spark, wh_small, tmp_path):
    """One grouping over a union, or co-located joins of bucketed tables: the same documents."""
    import json

    from accounthealth.operators import workspace as ws
    from accounthealth.plans.warehouse import Warehouse
    from accounthealth.sources.sinks import write_tables

    def documents(wh):
        rows = ws.account_detail(wh).toJSON().collect()
        return sorted(json.dumps(json.loads(r), sort_keys=True) for r in rows)

    bucketed = Warehouse.from_testdata(spark, "/root/testdata/sf0.001")
    write_tables(bucketed, f"{tmp_path}/wh", buckets=4)
    assert documents(bucketed) == documents(wh_small)
