"""Registered queries: the data-quality audit."""

from __future__ import annotations

from accounthealth.operators import quality
from accounthealth.plans.registry import register

# Independent SQL form: duplicates as rows past the first per id (window), the
# orphan check as left join + null test, as in the audit definition.
_OBSERVED_SQL = """
dq_observed AS (
    SELECT 1 AS position, 'duplicate_crm_accounts' AS name, 'critical' AS severity,
           0 AS threshold, FALSE AS zero_fails,
           (SELECT count(*) FROM (
                SELECT row_number() OVER (PARTITION BY CAST(account_id AS BIGINT)) AS rn
                FROM crm_accounts) WHERE rn > 1) AS observed,
           ' duplicate account_id values found in CRM accounts.' AS post
    UNION ALL
    SELECT 2, 'missing_company_size', 'warning', 0, FALSE,
           (SELECT count(*) FROM crm_accounts WHERE company_size IS NULL),
           ' CRM accounts are missing company_size.'
    UNION ALL
    SELECT 3, 'accepted_lifecycle_values', 'critical', 0, FALSE,
           (SELECT count(*) FROM crm_accounts
            WHERE lifecycle_stage IS NULL
               OR lifecycle_stage NOT IN ('lead', 'trial', 'customer', 'churned')),
           ' accounts have invalid lifecycle_stage values.'
    UNION ALL
    SELECT 4, 'negative_invoice_amount', 'critical', 0, FALSE,
           (SELECT count(*) FROM billing_invoices WHERE CAST(amount AS DOUBLE) < 0),
           ' invoices have negative amount values.'
    UNION ALL
    SELECT 5, 'subscription_end_before_start', 'critical', 0, FALSE,
           (SELECT count(*) FROM billing_subscriptions
            WHERE TRY_CAST(CAST(ended_at AS VARCHAR) AS TIMESTAMP)
                < TRY_CAST(CAST(started_at AS VARCHAR) AS TIMESTAMP)),
           ' subscriptions end before they start.'
    UNION ALL
    SELECT 6, 'null_product_event_names', 'warning', 0, FALSE,
           (SELECT count(*) FROM product_events WHERE event_name IS NULL),
           ' product events have null event_name.'
    UNION ALL
    SELECT 7, 'mart_customer_health_rows', 'critical', 1, TRUE,
           (SELECT count(*) FROM mart_customer_health),
           ' customer health rows built.'
    UNION ALL
    SELECT 8, 'churn_score_bounds', 'critical', 0, FALSE,
           (SELECT count(*) FROM mart_churn_risk
            WHERE churn_risk_score < 0 OR churn_risk_score > 100),
           ' churn scores outside 0-100.'
    UNION ALL
    SELECT 9, 'health_score_bounds', 'critical', 0, FALSE,
           (SELECT count(*) FROM mart_customer_health
            WHERE health_score < 0 OR health_score > 100),
           ' health scores outside 0-100.'
    UNION ALL
    SELECT 10, 'revenue_account_relationship', 'critical', 0, FALSE,
           (SELECT count(*) FROM fct_subscription_revenue r
            LEFT JOIN dim_accounts a ON r.account_id = a.account_id
            WHERE a.account_id IS NULL),
           ' revenue rows lack a valid account.'
),
dq_audit AS (
    SELECT position, name,
           CASE WHEN (CASE WHEN zero_fails THEN observed = 0 ELSE observed > 0 END)
                THEN CASE WHEN severity = 'critical' THEN 'fail' ELSE 'warn' END
                ELSE 'pass' END AS status,
           severity, CAST(observed AS BIGINT) AS observed, threshold,
           CAST(observed AS VARCHAR) || post AS detail
    FROM dq_observed
)
"""


def _audit_sql(body: str) -> str:
    return ", " + _OBSERVED_SQL.strip() + "\n" + body


_SINGLE_KEYS = {
    "dq_duplicate_accounts": "duplicate_crm_accounts",
    "dq_missing_company_size": "missing_company_size",
    "dq_accepted_lifecycle": "accepted_lifecycle_values",
    "dq_negative_invoice": "negative_invoice_amount",
    "dq_end_before_start": "subscription_end_before_start",
    "dq_null_event_names": "null_product_event_names",
    "dq_health_rows": "mart_customer_health_rows",
    "dq_churn_bounds": "churn_score_bounds",
    "dq_health_bounds": "health_score_bounds",
    "dq_revenue_orphans": "revenue_account_relationship",
}


def _single(key: str, check: str):
    register(key, _audit_sql(f"SELECT * FROM dq_audit WHERE name = '{check}'"))(
        lambda wh: quality.audit(wh, [check]))


for _key, _check in _SINGLE_KEYS.items():
    _single(_key, _check)


@register("dq_audit", _audit_sql("SELECT * FROM dq_audit"))
def dq_audit(wh):
    """Q11: all ten checks."""
    return quality.audit(wh)


@register("dq_summary", _audit_sql("""
SELECT count(*) AS total_checks,
       count(*) FILTER (WHERE status = 'pass') AS passed,
       count(*) FILTER (WHERE status = 'warn') AS warnings,
       count(*) FILTER (WHERE status = 'fail') AS failed,
       CASE WHEN count(*) FILTER (WHERE status = 'fail') > 0 THEN 'fail'
            WHEN count(*) FILTER (WHERE status = 'warn') > 0 THEN 'warn'
            ELSE 'pass' END AS status
FROM dq_audit
"""))
def dq_summary(wh):
    """Q12."""
    return quality.summary(quality.audit(wh))
