"""Registered queries: executive readout."""

from __future__ import annotations

from accounthealth.operators import reports
from accounthealth.plans.oracle import msum, savg, sql_money_text, sql_percent_text
from accounthealth.plans.registry import register


@register("rpt_kpis", f"""
SELECT count(*) AS accounts,
       {savg('h.health_score')} AS avg_health,
       {savg('c.churn_risk_score')} AS avg_churn_risk,
       {msum('h.recognized_revenue')} AS recognized_revenue,
       CAST(sum(CASE WHEN c.churn_risk_band = 'high' THEN 1 ELSE 0 END) AS BIGINT)
           AS high_risk_accounts
FROM mart_customer_health h
JOIN mart_churn_risk c USING (account_id)
""")
def rpt_kpis(wh):
    return reports.kpis(wh.table("scored_accounts"))


@register("rpt_top_risk", """
SELECT CAST(row_number() OVER (ORDER BY c.churn_risk_score DESC, h.recognized_revenue DESC,
                                   h.account_id) AS INTEGER) AS rank,
       h.account_id, h.account_name, h.segment, c.churn_risk_score, h.health_score,
       h.support_tickets, h.failed_invoice_amount
FROM mart_customer_health h
JOIN mart_churn_risk c USING (account_id)
ORDER BY rank
LIMIT 8
""")
def rpt_top_risk(wh):
    return reports.top_risk(wh.table("scored_accounts"))


@register("rpt_retention", f"""
SELECT segment, coalesce(plan, 'none') AS plan, accounts, recognized_revenue,
       gross_revenue_retention,
       {sql_money_text('recognized_revenue')} AS revenue_text,
       CASE WHEN gross_revenue_retention IS NULL THEN 'n/a'
            ELSE {sql_percent_text('gross_revenue_retention')} END AS grr_text,
       CAST(row_number() OVER (ORDER BY recognized_revenue DESC, segment NULLS LAST,
                                   plan NULLS LAST) AS INTEGER) AS rank
FROM mart_revenue_retention
""")
def rpt_retention(wh):
    return reports.retention_listing(wh.table("mart_revenue_retention"))


@register("rpt_health_by_segment", f"""
SELECT segment, {savg('health_score')} AS avg_health_score
FROM mart_customer_health
WHERE segment IS NOT NULL
GROUP BY segment
""")
def rpt_health_by_segment(wh):
    return reports.health_by_segment(wh.table("mart_customer_health"))


@register("rpt_churn_histogram", """
SELECT CAST(b.bin AS INTEGER) AS bin, CAST(b.bin * 5 AS INTEGER) AS bin_start,
       CAST((b.bin + 1) * 5 AS INTEGER) AS bin_end, coalesce(h.accounts, 0) AS accounts
FROM range(20) AS b(bin)
LEFT JOIN (
    SELECT CAST(floor(least(churn_risk_score, 99.999) / 5) AS INTEGER) AS bin,
           count(*) AS accounts
    FROM mart_churn_risk
    WHERE churn_risk_score IS NOT NULL
    GROUP BY 1
) h ON h.bin = b.bin
""")
def rpt_churn_histogram(wh):
    return reports.churn_histogram(wh.table("mart_churn_risk"))


def _automatic_bins_sql(column: str) -> str:
    steps = ", ".join(repr(s) for s in reports.BIN_STEPS)
    return f"""
, known AS (SELECT CAST({column} AS DOUBLE) AS v FROM mart_customer_health
            JOIN (SELECT account_id, churn_risk_score FROM mart_churn_risk) USING (account_id)
            WHERE {column} IS NOT NULL),
ends AS (SELECT min(v) AS lo, max(v) AS hi FROM known),
chosen AS (
    SELECT step, CAST(floor(lo / step) AS BIGINT) AS first, CAST(floor(hi / step) AS BIGINT) AS last
    FROM ends, (SELECT unnest([{steps}]::DOUBLE[]) AS step)
    WHERE floor(hi / step) - floor(lo / step) < 20
    ORDER BY step LIMIT 1
)
SELECT CAST(b.k - first AS INTEGER) AS bin, b.k * step AS bin_start, (b.k + 1) * step AS bin_end,
       (SELECT count(*) FROM known WHERE floor(v / step) = b.k) AS accounts
FROM chosen, LATERAL (SELECT unnest(range(first, last + 1)) AS k) b
"""


@register("rpt_churn_histogram_auto", _automatic_bins_sql("churn_risk_score"))
def rpt_churn_histogram_auto(wh):
    """R5 with automatic bins over the risk score."""
    return reports.automatic_histogram(wh.table("scored_accounts"), "churn_risk_score")


@register("rpt_revenue_histogram_auto", _automatic_bins_sql("recognized_revenue"))
def rpt_revenue_histogram_auto(wh):
    """The same bins over a column whose range is not known beforehand."""
    return reports.automatic_histogram(wh.table("scored_accounts"), "recognized_revenue")


@register("rpt_retention_series", """
SELECT segment, coalesce(plan, 'none') AS plan, gross_revenue_retention
FROM mart_revenue_retention
WHERE segment IS NOT NULL
""")
def rpt_retention_series(wh):
    return reports.retention_series(wh.table("mart_revenue_retention"))


@register("rpt_adoption_top", """
SELECT CAST(row_number() OVER (ORDER BY adoption_rate DESC NULLS LAST, segment NULLS LAST,
                                   event_name NULLS LAST) AS INTEGER) AS rank,
       segment, event_name, events, adopting_accounts, adoption_rate
FROM mart_product_adoption
ORDER BY rank
LIMIT 12
""")
def rpt_adoption_top(wh):
    return reports.adoption_top(wh.table("mart_product_adoption"))
