"""Hand-made edge rows the driver bindings do not contain (FIXTURES part C)."""

import pytest
from pyspark.sql import functions as F

from accounthealth.operators import marts, quality
from accounthealth.operators import workspace as ws
from accounthealth.plans.warehouse import Warehouse
from accounthealth.sources.schemas import SOURCE_NAMES, raw_text_schema

ACCOUNTS = [
    # account_id, name, industry, region, segment, lifecycle, size, created_at
    (1, "Acme old", "SaaS", "NA", "startup", "customer", 25, "2024-01-01"),
    (1, "Acme", "SaaS", "NA", "startup", "customer", 25, "2024-03-01"),
    (2, "Beta", "Fintech", "EMEA", "mid_market", None, 75, "2024-01-01"),
    (3, "Gamma", "Retail", "APAC", "enterprise", "paused", None, "2024-01-01"),
    (None, "Null one", "SaaS", "NA", "startup", "lead", 25, "2024-01-01"),
    (None, "Null two", "SaaS", "NA", "startup", "lead", 25, "2024-01-02"),
    (4, "Delta", "SaaS", "LATAM", "startup", "churned", 150, "2024-01-01"),
    (5, "Quiet", "SaaS", "NA", "startup", "customer", 400, "2024-01-01"),
]
SUBSCRIPTIONS = [
    # subscription_id, account_id, plan, status, started_at, ended_at, mrr
    (10, 1, "starter", "active", "2025-01-01", "bad-date", 900.0),
    (11, 1, "growth", "active", "2025-06-01", None, 3500.0),
    (12, 1, "enterprise", "active", None, None, 12500.0),
    (20, 4, "starter", "canceled", "2025-02-01", "2025-09-01", 900.0),
    (21, 4, "growth", "canceled", "2025-02-01", "2024-01-01", 900.0),
]
INVOICES = (
    # nine invoices on one day for account 1, amounts out of order
    [(100 + i, 11, 1, "2026-01-01", a, "paid") for i, a in
     enumerate([50.0, 10.0, 90.0, 30.0, 70.0, 20.0, 80.0, 40.0, 60.0])]
    + [(200, 20, 4, "2026-01-05", -25.0, "failed"),
       (300, 99, 99, "2026-01-05", 10.0, "paid")]       # no such account
)
EVENTS = [
    # event_id, account_id, event_name, event_at, user_role
    (1, 1, None, "2026-01-01 09:00:00", "admin"),
    (2, 1, None, "2026-01-01 10:00:00", "admin"),
    (3, 1, "login", "2026-01-02 09:00:00", "member"),
    (4, 1, "export_report", "2026-01-02 10:00:00", "member"),
]


def _raw(spark, source, rows):
    text = [tuple(None if v is None else str(v) for v in r) for r in rows]
    return spark.createDataFrame(text, raw_text_schema(source))


def _warehouse(spark, **tables):
    sources = {name: _raw(spark, name, tables.get(name, [])) for name in SOURCE_NAMES}
    return Warehouse(spark, sources)


@pytest.fixture(scope="module")
def edge_wh(spark):
    return _warehouse(spark, crm_accounts=ACCOUNTS, billing_subscriptions=SUBSCRIPTIONS,
                      billing_invoices=INVOICES, product_events=EVENTS)


def _by_id(df):
    return {r["account_id"]: r for r in df.collect()}


def test_dedupe_keeps_latest_and_one_null_row(edge_wh):
    acc = edge_wh.table("stg_crm_accounts").collect()
    ids = sorted((r["account_id"] is None, r["account_id"]) for r in acc)
    assert len(acc) == 6 and ids.count((True, None)) == 1
    assert _by_id(edge_wh.table("dim_accounts"))[1]["account_name"] == "Acme"


def test_latest_subscription_nulls_last_and_tie_break(edge_wh):
    cust = _by_id(edge_wh.table("dim_customers"))
    assert cust[1]["plan"] == "growth"            # 2025-06-01 beats 2025-01-01 and null
    assert cust[4]["plan"] == "growth"            # same start: higher subscription id
    assert cust[5]["plan"] is None and cust[5]["subscription_status"] is None


def test_bad_end_date_is_null(edge_wh):
    ends = {r["subscription_id"]: r["ended_at"]
            for r in edge_wh.table("stg_billing_subscriptions").collect()}
    assert ends[10] is None and str(ends[21]) == "2024-01-01"


def test_null_name_day_counts_as_active_day(edge_wh):
    days = {str(r["usage_date"]): r for r in edge_wh.table("fct_product_usage_daily").collect()}
    assert days["2026-01-01"]["events"] == 2
    assert days["2026-01-01"]["distinct_features_used"] == 0
    assert days["2026-01-01"]["null_event_names"] == 2
    summary = _by_id(edge_wh.table("mart_account_summary"))
    assert summary[1]["avg_daily_features"] == 1.0 and summary[1]["total_events"] == 4


def test_no_activity_account_is_zeros(edge_wh):
    s = _by_id(edge_wh.table("mart_account_summary"))[5]
    assert (s["total_events"], s["recognized_revenue"], s["support_tickets"],
            s["high_priority_tickets"], s["avg_resolved_hours"], s["plan"]) == (0, 0.0, 0, 0,
                                                                               0.0, None)
    health = _by_id(edge_wh.table("mart_customer_health"))[5]["health_score"]
    assert health == 45.0


def test_negative_failed_amount_has_no_penalty(edge_wh):
    h = _by_id(edge_wh.table("mart_customer_health"))[4]
    assert h["failed_invoice_amount"] == -25.0
    assert h["health_score"] == 45 - 35          # churned only, no billing penalty
    r = _by_id(edge_wh.table("mart_churn_risk"))[4]
    assert r["churn_risk_score"] == 100 and r["churn_risk_band"] == "already_churned"


def test_band_edges(spark):
    df = spark.createDataFrame([(45.0,), (45.0001,), (65.0,), (65.0001,)], "health_score double") \
        .withColumn("lifecycle_stage", F.lit("customer"))
    bands = [r[0] for r in df.select(marts.churn_risk_band_expr()).collect()]
    assert bands == ["high", "medium", "medium", "low"]


def test_zero_revenue_group_has_null_grr(edge_wh):
    rows = edge_wh.table("mart_revenue_retention").collect()
    no_plan = [r for r in rows if r["plan"] is None]
    assert no_plan and all(r["gross_revenue_retention"] is None for r in no_plan)


def test_quality_edge_counts(edge_wh):
    audit = {r["name"]: r for r in quality.audit(edge_wh).collect()}
    assert audit["duplicate_crm_accounts"]["observed"] == 2      # id 1 twice, null twice
    assert audit["accepted_lifecycle_values"]["observed"] == 2   # null and paused
    assert audit["missing_company_size"]["observed"] == 1
    assert audit["missing_company_size"]["status"] == "warn"
    assert audit["subscription_end_before_start"]["observed"] == 1
    assert audit["negative_invoice_amount"]["observed"] == 1
    assert audit["revenue_account_relationship"]["observed"] == 1
    assert audit["revenue_account_relationship"]["status"] == "fail"
    assert audit["duplicate_crm_accounts"]["detail"] == \
        "2 duplicate account_id values found in CRM accounts."


def test_more_than_eight_invoices_on_a_day(edge_wh):
    recent = ws.record_list(edge_wh, "invoices").filter("account_id = 1").orderBy("rn").collect()
    assert len(recent) == 8
    assert [r["amount"] for r in recent] == [10.0, 20.0, 30.0, 40.0, 50.0, 60.0, 70.0, 80.0]


def test_empty_sources_fail_health_rows(spark):
    wh = _warehouse(spark)
    audit = {r["name"]: r for r in quality.audit(wh).collect()}
    assert audit["mart_customer_health_rows"]["observed"] == 0
    assert audit["mart_customer_health_rows"]["status"] == "fail"
    summary = quality.summary(quality.audit(wh)).collect()[0]
    assert summary["status"] == "fail"
    assert ws.account_detail(wh).count() == 0


def test_reason_rules_on_edge_rows(edge_wh):
    q = _by_id(ws.attention_queue(edge_wh))
    labels = {k: [r["label"] for r in v["attention_reasons"]] for k, v in q.items()}
    assert labels[4][0] == "Lifecycle is churned"
    assert "Billing needs review" not in labels[4]             # net failed amount < 0
    assert labels[5][0] in ("Below segment feature variety", "Low composite health")
    for v in q.values():
        assert 1 <= len(v["attention_reasons"]) <= 4
        assert v["primary_reason"] == v["attention_reasons"][0]["label"]
