"""Model invariants on the driver bindings."""

from pyspark.sql import functions as F

from accounthealth.operators import quality
from accounthealth.plans.warehouse import MODEL_NAMES


def test_one_health_row_per_account(wh_mid):
    health = wh_mid.table("mart_customer_health")
    assert health.count() == health.select("account_id").distinct().count() == 1500


def test_scores_in_bounds(wh_mid):
    risk = wh_mid.table("mart_churn_risk")
    bad = risk.filter((F.col("health_score") < 0) | (F.col("health_score") > 100)
                      | (F.col("churn_risk_score") < 0) | (F.col("churn_risk_score") > 100))
    assert bad.count() == 0
    assert risk.agg(F.max("health_score")).first()[0] <= 85


def test_band_counts_sf001(wh_mid):
    bands = {r[0]: r[1] for r in
             wh_mid.table("mart_churn_risk").groupBy("churn_risk_band").count().collect()}
    assert bands == {"already_churned": 118, "high": 1258, "medium": 123, "low": 1}


def test_retention_accounts_and_revenue_add_up(wh_mid):
    ret = wh_mid.table("mart_revenue_retention").agg(F.sum("accounts"),
                                                      F.sum("recognized_revenue")).first()
    fact = wh_mid.table("fct_subscription_revenue").agg(
        F.sum(F.col("recognized_revenue").cast("decimal(28,6)"))).first()[0]
    assert ret[0] == 1500
    assert abs(ret[1] - float(fact)) < 1e-6


def test_failed_amount_signs(wh_mid):
    h = wh_mid.table("mart_customer_health")
    assert h.filter("failed_invoice_amount > 0").count() == 347
    assert h.filter("failed_invoice_amount < 0").count() == 16


def test_adoption_rate_is_one_as_modeled(wh_mid):
    rates = {r[0] for r in wh_mid.table("mart_product_adoption").select("adoption_rate").collect()}
    assert rates == {1.0}
    seg = wh_mid.table("mart_segment_adoption").collect()
    assert all(0 < r["segment_adoption_rate"] <= 1 for r in seg)


def test_literal_dimensions(wh_small):
    dates = wh_small.table("dim_date")
    assert dates.count() == 730
    first = dates.orderBy("date_day").first()
    assert (str(first["date_day"]), first["year"], first["month"], str(first["quarter_start"])) \
        == ("2025-01-01", 2025, 1, "2025-01-01")
    assert {r["plan"]: r["base_mrr"] for r in wh_small.table("dim_plans").collect()} == \
        {"starter": 900, "growth": 3500, "enterprise": 12500}


def test_manifest_lists_every_model(wh_small):
    rows = wh_small.manifest().collect()
    assert [r["table"] for r in rows] == sorted(MODEL_NAMES)
    assert {r["table"]: r["rows"] for r in rows}["mart_churn_risk"] == 150


def test_audit_on_bindings_sf001(wh_mid):
    audit = {r["name"]: r for r in quality.audit(wh_mid).collect()}
    observed = {k: v["observed"] for k, v in audit.items()}
    assert observed["duplicate_crm_accounts"] == 15
    assert observed["missing_company_size"] == 90
    assert observed["negative_invoice_amount"] == 58
    assert observed["subscription_end_before_start"] == 2
    assert observed["null_product_event_names"] == 2115
    assert observed["accepted_lifecycle_values"] == 0
    assert observed["mart_customer_health_rows"] == 1500
    assert [r["position"] for r in quality.audit(wh_mid).orderBy("position").collect()] == \
        list(range(1, 11))
    s = quality.summary(quality.audit(wh_mid)).first()
    assert (s["total_checks"], s["passed"], s["warnings"], s["failed"], s["status"]) == \
        (10, 5, 2, 3, "fail")
