"""Queue-exploration operators.

What the workspace viewer does to the attention queue (search, filters, four
sort modes, paging, next action, driver flags, export, account brief,
observed facts) as DataFrame functions over every account. Paging and the
top-n panels are the only limits, and they are the feature.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accounthealth.functions.cache import per_context
from accounthealth.functions.position import with_position
from accounthealth.functions.text import DOT, js_currency, js_number, risk_label, title_case
from accounthealth.operators import workspace as ws
from accounthealth.plans.warehouse import Warehouse

PAGE_SIZE = 30
ALL = "all"

# Next actions in rule order.
ACTION_BILLING = "Review failed billing"
ACTION_CHURN = "Confirm churn recovery plan"
ACTION_SUPPORT = "Follow up on support load"
ACTION_ADOPTION = "Run an adoption check-in"
ACTION_MONITOR = "Monitor next refresh"

# Export header, in column order.
EXPORT_COLUMNS = ["account_id", "account_name", "segment", "region", "lifecycle_stage",
                  "risk_band", "churn_risk_score", "health_score", "recognized_revenue",
                  "primary_reason", "next_action"]

# Payload notes quoted at the end of every account brief.
SOURCE_NOTE = ("Synthetic deterministic demo data. No production usage, customer outcomes, "
               "revenue impact, or model validation is claimed.")
MODEL_NOTE = ("No ML model is present in this repository. Health and churn risk are "
              "deterministic heuristic scores from the existing SQL marts.")

# Brief headings and observed-fact labels.
BRIEF_TITLE = "CUSTOMER HEALTH ACCOUNT BRIEF"
FACT_LABELS = ["CRM lifecycle", "Recognized revenue", "Product events", "Support records"]


def _num(name: str) -> Column:
    """A numeric field read the viewer's way: missing as zero."""
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def _text(col: Column) -> Column:
    """A value spliced into text the viewer's way (missing reads ``null``)."""
    return F.coalesce(col.cast("string"), F.lit("null"))


# Sort modes: (primary key, secondary key); missing values sort as zero.
SORT_MODES: dict[str, tuple[tuple[str, str], tuple[str, str]]] = {
    "risk": (("churn_risk_score", "desc"), ("recognized_revenue", "desc")),
    "revenue": (("recognized_revenue", "desc"), ("churn_risk_score", "desc")),
    "health": (("health_score", "asc"), ("churn_risk_score", "desc")),
    "support": (("high_priority_tickets", "desc"), ("churn_risk_score", "desc")),
}


def sort_order(mode: str = "risk") -> list[Column]:
    """The mode's keys, then the queue order the viewer received (its sort
    is stable), so every mode is a total order."""
    keys = [_num(c).desc() if d == "desc" else _num(c).asc()
            for c, d in SORT_MODES.get(mode, SORT_MODES["risk"])]
    return keys + ws.queue_order()


def viewer_queue(wh: Warehouse) -> DataFrame:
    """The queue rows the viewer holds, with the viewer's segment median
    (nulls as zero, null segment is a group) and the next action (A8/A9)."""
    joined = ws.attention_queue(wh).drop("segment_median_features")
    median = F.coalesce(F.col("viewer_segment_median"), F.lit(0.0))
    action = (
        F.when(_num("failed_invoice_amount") > 0, ACTION_BILLING)
        .when(_text(F.col("lifecycle_stage")) == "churned", ACTION_CHURN)
        .when(_num("high_priority_tickets") > 0, ACTION_SUPPORT)
        .when(_num("avg_daily_features") < median, ACTION_ADOPTION)
        .otherwise(ACTION_MONITOR)
    )
    return joined.withColumn("next_action", action)


def searchable_text() -> Column:
    """What a search looks at: name, id, industry and region, lower-cased."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit(""))
                                      for c in ("account_name", "account_id", "industry",
                                                "region")]))


def search(df: DataFrame, query: str) -> DataFrame:
    """A1: trimmed, lower-cased substring of name, id, industry, region."""
    q = (query or "").strip().lower()
    return df.filter(searchable_text().contains(F.lit(q))) if q else df


def filter_queue(df: DataFrame, risk: str = ALL, segment: str = ALL,
                 lifecycle: str = ALL) -> DataFrame:
    """A2: equality filters; ``all`` disables one."""
    for column, value in (("churn_risk_band", risk), ("segment", segment),
                          ("lifecycle_stage", lifecycle)):
        if value != ALL:
            df = df.filter(F.col(column) == value)
    return df


def explore(wh: Warehouse, query: str = "", risk: str = ALL, segment: str = ALL,
            lifecycle: str = ALL, sort: str = "risk") -> DataFrame:
    """A1-A3: filtered and sorted queue (a distributed range sort)."""
    rows = filter_queue(search(viewer_queue(wh), query), risk, segment, lifecycle)
    return rows.orderBy(*sort_order(sort))


def ranked_queue(wh: Warehouse, sort: str = "risk", **filters) -> DataFrame:
    """A3: every row of the (filtered) queue with its rank in the mode's order."""
    rows = filter_queue(search(viewer_queue(wh), filters.pop("query", "")), **filters)
    return with_position(rows, sort_order(sort))


def page(wh: Warehouse, pages: int = 1, sort: str = "risk", **filters) -> DataFrame:
    """A4: the first ``pages`` x 30 rows, ranked. The limit plans as a
    per-task top-k; the rank window only sees the kept rows."""
    rows = filter_queue(search(viewer_queue(wh), filters.pop("query", "")), **filters)
    order = sort_order(sort)
    top = rows.orderBy(*order).limit(PAGE_SIZE * pages)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def filter_options(wh: Warehouse) -> DataFrame:
    """A5: sorted distinct segments and lifecycle stages."""
    queue = ws.queue_base(wh)
    seg = queue.select(F.lit("segment").alias("option"), F.col("segment").alias("value"))
    life = queue.select(F.lit("lifecycle").alias("option"),
                        F.col("lifecycle_stage").alias("value"))
    distinct = seg.unionByName(life).distinct()
    return distinct.withColumn("position", F.row_number().over(
        Window.partitionBy("option").orderBy(F.col("value").asc_nulls_last())))


def best_adoption(wh: Warehouse, k: int = 7) -> DataFrame:
    """Per event, the highest-rate row (first segment on ties), top k."""
    adoption = wh.table("mart_product_adoption")
    rate = F.coalesce(F.col("adoption_rate"), F.lit(0.0))
    per_event = Window.partitionBy("event_name").orderBy(rate.desc(),
                                                         F.col("segment").asc_nulls_last())
    best = adoption.withColumn("_r", F.row_number().over(per_event)).filter("_r = 1").drop("_r")
    order = [rate.desc(), F.col("event_name").asc_nulls_last()]
    top = best.orderBy(*order).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def top_retention(wh: Warehouse, k: int = 8) -> DataFrame:
    """First k rows of the retention listing."""
    return ws.retention_listing(wh).filter(F.col("rank") <= k)


def next_actions(wh: Warehouse) -> DataFrame:
    """Default next action per account."""
    return viewer_queue(wh).select("account_id", "segment", "viewer_segment_median",
                                   "next_action")


def account_drivers(wh: Warehouse) -> DataFrame:
    """A10: the four driver flags per account."""
    q = viewer_queue(wh)
    median = F.coalesce(F.col("viewer_segment_median"), F.lit(0.0))
    return q.select(
        "account_id",
        (_num("failed_invoice_amount") > 0).alias("billing_alert"),
        (_num("avg_daily_features") < median).alias("adoption_gap"),
        (_num("high_priority_tickets") > 0).alias("support_alert"),
        (_text(F.col("lifecycle_stage")) == "churned").alias("lifecycle_alert"),
    )


def export_rows(wh: Warehouse, sort: str = "risk", **filters) -> DataFrame:
    """Export columns of the filtered, sorted queue."""
    rows = explore(wh, sort=sort, **filters)
    return rows.select(
        "account_id", "account_name", "segment", "region", "lifecycle_stage",
        F.col("churn_risk_band").alias("risk_band"), "churn_risk_score", "health_score",
        "recognized_revenue", "primary_reason", "next_action")


@per_context
def brief_text() -> Column:
    """The account brief of one queue row, as one text column."""
    c = F.col
    lines = [
        F.lit(BRIEF_TITLE), F.lit(""),
        F.concat(_text(c("account_name")), F.lit(DOT), _text(c("account_id"))),
        F.concat(F.lit("Risk band: "), risk_label(c("churn_risk_band")), F.lit(" ("),
                 js_number(c("churn_risk_score"), 1), F.lit("/100)")),
        F.concat(F.lit("Health score: "), js_number(c("health_score"), 1), F.lit("/100")),
        F.concat(F.lit("Segment: "), title_case(c("segment")), F.lit(DOT), _text(c("region")),
                 F.lit(DOT), title_case(c("lifecycle_stage"))),
        F.lit(""), F.lit("RECOMMENDED NEXT ACTION"), c("next_action"), F.lit(""),
        F.lit("OBSERVED FACTS"),
        F.concat(F.lit("Recognized revenue: "), js_currency(c("recognized_revenue"))),
        F.concat(F.lit("Failed invoice amount: "), js_currency(c("failed_invoice_amount"))),
        F.concat(F.lit("Product events: "), js_number(c("total_events"))),
        F.concat(F.lit("Average daily feature variety: "), js_number(c("avg_daily_features"), 1)),
        F.concat(F.lit("Support tickets: "), js_number(c("support_tickets")), F.lit(" ("),
                 js_number(c("high_priority_tickets")), F.lit(" high priority)")),
        F.lit(""), F.lit("SOURCE NOTE"), F.lit(SOURCE_NOTE), F.lit(MODEL_NOTE),
    ]
    return F.concat(F.concat_ws("\n", *lines), F.lit("\n"))


def account_brief(wh: Warehouse) -> DataFrame:
    """The account brief text for every account."""
    return viewer_queue(wh).select("account_id", brief_text().alias("brief"))


def heuristic_flags(wh: Warehouse) -> DataFrame:
    """Reasons of type ``heuristic`` per account, flattened in order."""
    q = ws.attention_queue(wh)
    flags = F.filter("attention_reasons", lambda r: r["type"] == "heuristic")
    return q.select("account_id", F.posexplode(flags).alias("pos", "r")).select(
        "account_id", (F.col("pos") + 1).alias("position"), "r.label", "r.source", "r.detail")


@per_context
def observed_fact_list() -> Column:
    """The four label/detail facts of one queue row."""
    c = F.col
    details = [
        F.concat(title_case(c("lifecycle_stage")), F.lit(DOT), title_case(c("segment")),
                 F.lit(DOT), _text(c("region"))),
        F.concat(js_currency(c("recognized_revenue")),
                 F.lit(" from paid, positive invoice records.")),
        F.concat(js_number(c("total_events")), F.lit(" event rows in the product source.")),
        F.concat(js_number(c("support_tickets")), F.lit(" tickets"), F.lit(DOT),
                 js_number(c("high_priority_tickets")), F.lit(" high priority.")),
    ]
    return F.array(*[F.struct(F.lit(label).alias("label"), d.alias("detail"))
                     for label, d in zip(FACT_LABELS, details)])


def observed_facts(wh: Warehouse) -> DataFrame:
    """Four label/detail facts per account, flattened in order."""
    q = ws.queue_base(wh)
    return q.select("account_id", F.posexplode(observed_fact_list()).alias("pos", "f")).select(
        "account_id", (F.col("pos") + 1).alias("position"), "f.label", "f.detail")
