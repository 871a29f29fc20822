"""Registered queries: queue exploration."""

from __future__ import annotations

from accounthealth.operators import explorer as ex
from accounthealth.operators import search_index
from accounthealth.operators.workspace import queue_base
from accounthealth.plans.catalog_workspace import REASONS_SQL
from accounthealth.plans.oracle import (sql_js_currency, sql_js_number, sql_risk_label,
                                        sql_title_case)
from accounthealth.plans.registry import register
from accounthealth.session import scratch_folder

# Parameters of the registered runs (the viewer's controls).
SEARCH_QUERY = "  Building "
FILTER = {"risk": "high", "segment": "enterprise", "lifecycle": "all"}
PAGES = 2

_VIEWER_SQL = REASONS_SQL.strip() + """,
viewer_median AS (
    SELECT segment, median(coalesce(avg_daily_features, 0)) AS viewer_segment_median
    FROM queue GROUP BY segment
),
viewer AS (
    SELECT q.*, m.viewer_segment_median,
           CASE WHEN coalesce(q.failed_invoice_amount, 0) > 0 THEN 'Review failed billing'
                WHEN coalesce(q.lifecycle_stage, 'null') = 'churned'
                    THEN 'Confirm churn recovery plan'
                WHEN coalesce(q.high_priority_tickets, 0) > 0 THEN 'Follow up on support load'
                WHEN coalesce(q.avg_daily_features, 0) < coalesce(m.viewer_segment_median, 0)
                    THEN 'Run an adoption check-in'
                ELSE 'Monitor next refresh' END AS next_action
    FROM queue q
    LEFT JOIN viewer_median m ON q.segment IS NOT DISTINCT FROM m.segment
)
"""

_LIST_COLUMNS = ["account_id", "account_name", "industry", "region", "segment",
                 "lifecycle_stage", "churn_risk_band", "churn_risk_score", "recognized_revenue",
                 "next_action"]
_SORT_SQL = {
    "risk": "coalesce(churn_risk_score, 0) DESC, coalesce(recognized_revenue, 0) DESC",
    "revenue": "coalesce(recognized_revenue, 0) DESC, coalesce(churn_risk_score, 0) DESC",
    "health": "coalesce(health_score, 0) ASC, coalesce(churn_risk_score, 0) DESC",
    "support": "coalesce(high_priority_tickets, 0) DESC, coalesce(churn_risk_score, 0) DESC",
}
_QUEUE_ORDER_SQL = "churn_risk_score DESC, recognized_revenue DESC, account_id ASC"


def _viewer(body: str) -> str:
    return _VIEWER_SQL + body


_SEARCH_SQL = _viewer(f"""
SELECT {', '.join(_LIST_COLUMNS)} FROM viewer
WHERE contains(lower(coalesce(account_name, '') || ' ' || coalesce(CAST(account_id AS VARCHAR), '')
                     || ' ' || coalesce(industry, '') || ' ' || coalesce(region, '')),
               '{SEARCH_QUERY.strip().lower()}')
""")


@register("app_queue_search", _SEARCH_SQL)
def app_queue_search(wh):
    """A1 (query ``SEARCH_QUERY``)."""
    return ex.explore(wh, query=SEARCH_QUERY).select(*_LIST_COLUMNS)


@register("app_queue_search_indexed", _SEARCH_SQL)
def app_queue_search_indexed(wh):
    """A1 over a stored index of the queue's searchable text."""
    path = scratch_folder(wh.spark)
    search_index.write_index(queue_base(wh), path)
    return search_index.indexed_search(ex.viewer_queue(wh), path, SEARCH_QUERY).select(
        *_LIST_COLUMNS)


@register("app_queue_filter", _viewer(f"""
SELECT {', '.join(_LIST_COLUMNS)} FROM viewer
WHERE churn_risk_band = '{FILTER['risk']}' AND segment = '{FILTER['segment']}'
"""))
def app_queue_filter(wh):
    """A2 (band ``high``, segment ``enterprise``, any lifecycle)."""
    return ex.explore(wh, **FILTER).select(*_LIST_COLUMNS)


_SORT_COLUMNS = ["account_id", "churn_risk_score", "recognized_revenue", "health_score",
                 "high_priority_tickets"]


def _sort_query(mode: str):
    """A3: the whole queue, each row with its position in the mode's order."""
    register(f"app_sort_{mode}", _viewer(f"""
SELECT {', '.join(_SORT_COLUMNS)},
       row_number() OVER (ORDER BY {_SORT_SQL[mode]}, {_QUEUE_ORDER_SQL}) AS rank
FROM viewer
"""))(lambda wh: ex.ranked_queue(wh, sort=mode).select(*_SORT_COLUMNS, "rank"))


for _mode in ex.SORT_MODES:
    _sort_query(_mode)


@register("app_queue_page", _viewer(f"""
SELECT {', '.join(_LIST_COLUMNS)},
       CAST(row_number() OVER (ORDER BY {_SORT_SQL['risk']}, {_QUEUE_ORDER_SQL}) AS INTEGER)
           AS rank
FROM viewer
ORDER BY rank
LIMIT {ex.PAGE_SIZE * PAGES}
"""))
def app_queue_page(wh):
    """A4: two pages (the first 60 rows) of the risk-sorted queue."""
    return ex.page(wh, pages=PAGES).select(*_LIST_COLUMNS, "rank")


@register("app_filter_options", """
SELECT option, value,
       CAST(row_number() OVER (PARTITION BY option ORDER BY value NULLS LAST) AS INTEGER)
           AS position
FROM (SELECT 'segment' AS option, segment AS value FROM health_risk
      UNION
      SELECT 'lifecycle', lifecycle_stage FROM health_risk)
""")
def app_filter_options(wh):
    return ex.filter_options(wh)


@register("app_best_adoption", """
SELECT segment, event_name, events, adopting_accounts, adoption_rate,
       CAST(row_number() OVER (ORDER BY coalesce(adoption_rate, 0) DESC, event_name NULLS LAST)
            AS INTEGER) AS rank
FROM (
    SELECT * FROM mart_product_adoption
    QUALIFY row_number() OVER (PARTITION BY event_name
                               ORDER BY coalesce(adoption_rate, 0) DESC, segment NULLS LAST) = 1
)
ORDER BY rank
LIMIT 7
""")
def app_best_adoption(wh):
    return ex.best_adoption(wh)


@register("app_top_retention", """
SELECT * FROM (
    SELECT *, CAST(row_number() OVER (ORDER BY recognized_revenue DESC, segment NULLS LAST,
                                            plan NULLS LAST) AS INTEGER) AS rank
    FROM mart_revenue_retention
) WHERE rank <= 8
""")
def app_top_retention(wh):
    return ex.top_retention(wh)


@register("app_next_action", _viewer(
    "SELECT account_id, segment, viewer_segment_median, next_action FROM viewer"))
def app_next_action(wh):
    """A8/A9."""
    return ex.next_actions(wh)


@register("app_account_drivers", _viewer("""
SELECT account_id,
       coalesce(failed_invoice_amount, 0) > 0 AS billing_alert,
       coalesce(avg_daily_features, 0) < coalesce(viewer_segment_median, 0) AS adoption_gap,
       coalesce(high_priority_tickets, 0) > 0 AS support_alert,
       coalesce(lifecycle_stage, 'null') = 'churned' AS lifecycle_alert
FROM viewer
"""))
def app_account_drivers(wh):
    return ex.account_drivers(wh)


@register("app_queue_export", _viewer("""
SELECT account_id, account_name, segment, region, lifecycle_stage,
       churn_risk_band AS risk_band, churn_risk_score, health_score, recognized_revenue,
       primary_reason, next_action
FROM viewer
"""))
def app_queue_export(wh):
    """A11 (default view: no filter, risk sort); the CSV sink writes it."""
    return ex.export_rows(wh)


def _nl(*parts: str) -> str:
    return " || chr(10) || ".join(parts)


_BRIEF = _nl(
    "'CUSTOMER HEALTH ACCOUNT BRIEF'", "''",
    "coalesce(account_name, 'null') || ' · ' || coalesce(CAST(account_id AS VARCHAR), 'null')",
    f"'Risk band: ' || {sql_risk_label('churn_risk_band')} || ' (' "
    f"|| {sql_js_number('churn_risk_score', 1)} || '/100)'",
    f"'Health score: ' || {sql_js_number('health_score', 1)} || '/100'",
    f"'Segment: ' || {sql_title_case('segment')} || ' · ' || coalesce(region, 'null') || ' · ' "
    f"|| {sql_title_case('lifecycle_stage')}",
    "''", "'RECOMMENDED NEXT ACTION'", "next_action", "''", "'OBSERVED FACTS'",
    f"'Recognized revenue: ' || {sql_js_currency('recognized_revenue')}",
    f"'Failed invoice amount: ' || {sql_js_currency('failed_invoice_amount')}",
    f"'Product events: ' || {sql_js_number('total_events')}",
    f"'Average daily feature variety: ' || {sql_js_number('avg_daily_features', 1)}",
    f"'Support tickets: ' || {sql_js_number('support_tickets')} || ' (' "
    f"|| {sql_js_number('high_priority_tickets')} || ' high priority)'",
    "''", "'SOURCE NOTE'",
    "'Synthetic deterministic demo data. No production usage, customer outcomes, revenue "
    "impact, or model validation is claimed.'",
    "'No ML model is present in this repository. Health and churn risk are deterministic "
    "heuristic scores from the existing SQL marts.'",
) + " || chr(10)"


@register("app_account_brief", _viewer(f"SELECT account_id, {_BRIEF} AS brief FROM viewer"))
def app_account_brief(wh):
    """A12/A13."""
    return ex.account_brief(wh)


@register("app_heuristic_flags", REASONS_SQL.strip() + """
SELECT account_id,
       CAST(row_number() OVER (PARTITION BY account_id ORDER BY position) AS INTEGER)
           AS position,
       label, source, detail
FROM reasons
WHERE position <= 4 AND type = 'heuristic'
""")
def app_heuristic_flags(wh):
    """A14."""
    return ex.heuristic_flags(wh)


@register("app_observed_facts", f"""
SELECT account_id, 1 AS position, 'CRM lifecycle' AS label,
       {sql_title_case('lifecycle_stage')} || ' · ' || {sql_title_case('segment')} || ' · '
       || coalesce(region, 'null') AS detail
FROM health_risk
UNION ALL
SELECT account_id, 2, 'Recognized revenue',
       {sql_js_currency('recognized_revenue')} || ' from paid, positive invoice records.'
FROM health_risk
UNION ALL
SELECT account_id, 3, 'Product events',
       {sql_js_number('total_events')} || ' event rows in the product source.'
FROM health_risk
UNION ALL
SELECT account_id, 4, 'Support records',
       {sql_js_number('support_tickets')} || ' tickets · '
       || {sql_js_number('high_priority_tickets')} || ' high priority.'
FROM health_risk
""")
def app_observed_facts(wh):
    """A15."""
    return ex.observed_facts(wh)
