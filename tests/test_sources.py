"""Source bindings and the CSV source."""

import pytest

from accounthealth.plans.warehouse import Warehouse
from accounthealth.sources import csv_source
from accounthealth.sources.schemas import COLUMNS, SOURCE_NAMES


def test_binding_counts_sf0001(wh_small):
    counts = {n: wh_small.raw(n).count() for n in SOURCE_NAMES}
    assert counts["crm_accounts"] == 152
    assert wh_small.raw("crm_accounts").select("account_id").distinct().count() == 150
    assert counts["billing_subscriptions"] == 111
    assert counts["billing_invoices"] == 1092
    assert counts["product_events"] == 1000
    assert counts["support_tickets"] == 493
    assert counts["crm_opportunities"] == 1500
    assert counts["crm_contacts"] == 4599
    assert counts["marketing_leads"] == 150


def test_binding_counts_sf001(wh_mid):
    assert wh_mid.raw("crm_accounts").count() == 1515
    assert wh_mid.raw("billing_invoices").count() == 11030
    assert wh_mid.raw("crm_contacts").count() == 45832
    assert wh_mid.raw("marketing_leads").count() == 1500


def test_source_columns_follow_contract(wh_small):
    for name in SOURCE_NAMES:
        assert wh_small.raw(name).columns == COLUMNS[name]


def _write_csv(path, header, rows):
    lines = [",".join(header)] + [",".join("" if v is None else str(v) for v in r) for r in rows]
    path.write_text("\n".join(lines) + "\n")


def test_missing_source_names_path(spark, tmp_path):
    with pytest.raises(FileNotFoundError) as err:
        csv_source.read_source(spark, str(tmp_path), "crm_accounts")
    assert "crm_accounts.csv" in str(err.value)


def test_csv_keeps_na_region_and_blank_end(spark, tmp_path):
    _write_csv(tmp_path / "crm_accounts.csv", COLUMNS["crm_accounts"],
               [[1, "Acme", "SaaS", "NA", "startup", "customer", None, "2024-02-01"]])
    _write_csv(tmp_path / "billing_subscriptions.csv", COLUMNS["billing_subscriptions"],
               [[1, 1, "starter", "active", "2025-01-01", None, 900.0],
                [2, 1, "starter", "active", "2025-01-01", "bad-date", 900.0]])
    wh = Warehouse(spark, {"crm_accounts": csv_source.read_source(spark, str(tmp_path),
                                                                  "crm_accounts"),
                           "billing_subscriptions": csv_source.read_source(
                               spark, str(tmp_path), "billing_subscriptions")})
    acc = wh.table("stg_crm_accounts").collect()
    assert acc[0]["region"] == "NA" and acc[0]["company_size"] is None
    ends = [r["ended_at"] for r in wh.table("stg_billing_subscriptions").collect()]
    assert ends == [None, None]


def test_csv_path_reproduces_binding_results(spark, wh_small, tmp_path):
    """Sources written as CSV and read back as text give the same marts."""
    from accounthealth.operators import quality

    for name in SOURCE_NAMES:
        (wh_small.raw(name).coalesce(1).write.option("header", True)
         .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
         .csv(str(tmp_path / f"{name}.csv")))
    from_csv = Warehouse.from_csv(spark, str(tmp_path))
    for model in ("mart_churn_risk", "mart_revenue_retention", "mart_product_adoption",
                  "fct_product_usage_daily"):
        a = sorted(map(tuple, from_csv.table(model).collect()), key=str)
        b = sorted(map(tuple, wh_small.table(model).collect()), key=str)
        assert a == b, model
    audit_csv = {r["name"]: r["observed"] for r in quality.audit(from_csv).collect()}
    audit_bin = {r["name"]: r["observed"] for r in quality.audit(wh_small).collect()}
    assert audit_csv == audit_bin
