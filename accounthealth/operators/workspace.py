"""Decision-workspace operators.

The attention queue, its rollups, per-account record lists and trends, source
coverage, and the nested per-account detail document. Everything is keyed
by ``account_id``: lists are ranked and cut per key before they are
collected, and the detail document joins one row per account from every
list, so all its inputs arrive partitioned on the same key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accounthealth.functions.cache import per_context
from accounthealth.functions.median import grouped_median
from accounthealth.functions.money import exact_avg, money_sum, score_avg
from accounthealth.functions.topk import nest_records, nested_lists, ranked_records
from accounthealth.operators.marts import usage_by_account
from accounthealth.plans.warehouse import Warehouse

QUEUE_COLUMNS = [
    "account_id", "account_name", "industry", "region", "segment", "lifecycle_stage",
    "company_size", "plan", "subscription_status", "total_events", "avg_daily_features",
    "recognized_revenue", "failed_invoice_amount", "support_tickets", "high_priority_tickets",
    "avg_resolved_hours", "health_score", "churn_risk_score", "churn_risk_band",
]


def queue_order() -> list[Column]:
    """Risk desc, revenue desc; account id breaks ties."""
    return [F.col("churn_risk_score").desc(), F.col("recognized_revenue").desc(),
            F.col("account_id").asc()]


ATTENTION_BANDS = ["high", "already_churned"]

# Attention reasons (label, type, source, detail text).
REASON_CHURNED = ("Lifecycle is churned", "observed", "CRM lifecycle_stage",
                  "The CRM record is marked churned; treat this as a recovery or closed-loop "
                  "review, not a prediction.")
REASON_BILLING = ("Billing needs review", "observed", "fct_subscription_revenue",
                  "${} is attached to failed invoice records.")
REASON_SUPPORT = ("High-priority support load", "observed", "fct_support_tickets",
                  "{} high or urgent ticket(s) are recorded.")
REASON_FEATURES = ("Below segment feature variety", "heuristic", "fct_product_usage_daily",
                   "{} average daily features versus a {} segment median.")
REASON_LOW_HEALTH = ("Low composite health", "heuristic", "mart_customer_health",
                     "The existing rule-based health score is below 50 on a 0–100 scale.")
REASON_MONITOR = ("Monitor", "heuristic", "mart_customer_health",
                  "No specific observed exception is present in the current source records.")
LOW_HEALTH_BELOW = 50
MAX_REASONS = 4

# Raw source coverage (label, table, date column).
COVERAGE_SOURCES = [
    ("CRM accounts", "crm_accounts", "created_at"),
    ("CRM contacts", "crm_contacts", "created_at"),
    ("CRM opportunities", "crm_opportunities", "created_at"),
    ("Billing subscriptions", "billing_subscriptions", "started_at"),
    ("Billing invoices", "billing_invoices", "invoice_date"),
    ("Product events", "product_events", "event_at"),
    ("Support tickets", "support_tickets", "created_at"),
    ("Marketing leads", "marketing_leads", "created_at"),
]


# --- W2: segment median -----------------------------------------------------

def segment_median(queue_base: DataFrame, value: str = "avg_daily_features",
                   name: str = "segment_median_features") -> DataFrame:
    """Exact (interpolated) median of ``value`` per segment, found by
    narrowing digit by digit (``functions.median``): no task ever holds
    a whole segment, however large one segment grows."""
    return grouped_median(queue_base, "segment", value, name)


# --- W1, W3-W5: the queue ---------------------------------------------------

def queue_base(wh: Warehouse) -> DataFrame:
    """Health joined to risk (rows with an id), 19 columns."""
    return wh.table("scored_accounts").filter(F.col("account_id").isNotNull()).select(*QUEUE_COLUMNS)


def _reason(spec: tuple[str, str, str, str], detail: Column | None = None) -> Column:
    label, kind, source, text = spec
    return F.struct(F.lit(label).alias("label"), F.lit(kind).alias("type"),
                    F.lit(source).alias("source"),
                    (detail if detail is not None else F.lit(text)).alias("detail"))


def feature_variety(wh: Warehouse) -> DataFrame:
    """``account_id, segment, avg_daily_features`` of the queue's accounts, from
    the usage aggregate and the accounts alone: the medians need none of the
    other facts, and share the usage exchanges with the queue rows."""
    if wh.is_bound("mart_account_summary"):
        rows = wh.table("mart_account_summary").select("account_id", "segment",
                                                       "avg_daily_features")
    else:
        usage = usage_by_account(wh.table("fct_product_usage_daily"))
        rows = wh.table("dim_accounts").join(usage, "account_id", "left").select(
            "account_id", "segment",
            F.coalesce("avg_daily_features", F.lit(0.0)).alias("avg_daily_features"))
    return rows.filter(F.col("account_id").isNotNull())


@per_context
def attention_reasons() -> Column:
    """Ordered rules, at most four; fallbacks only when none fired."""
    c = F.col
    failed = F.coalesce(c("failed_invoice_amount"), F.lit(0.0))
    high = F.coalesce(c("high_priority_tickets"), F.lit(0))
    features = F.coalesce(c("avg_daily_features"), F.lit(0.0))
    median = F.coalesce(c("segment_median_features"), F.lit(0.0))
    health = F.coalesce(c("health_score"), F.lit(0.0))
    billing_pre, billing_post = REASON_BILLING[3].split("{}")
    support_pre, support_post = REASON_SUPPORT[3].split("{}")
    feat_a, feat_b, feat_c = REASON_FEATURES[3].split("{}")
    fired = F.array_compact(F.array(
        F.when(c("lifecycle_stage") == "churned", _reason(REASON_CHURNED)),
        F.when(failed > 0, _reason(REASON_BILLING, F.concat(
            F.lit(billing_pre), F.format_number(failed, 0), F.lit(billing_post)))),
        F.when(high > 0, _reason(REASON_SUPPORT, F.concat(
            F.lit(support_pre), high.cast("string"), F.lit(support_post)))),
        F.when(features < median, _reason(REASON_FEATURES, F.concat(
            F.lit(feat_a), F.format_number(features, 1), F.lit(feat_b),
            F.format_number(median, 1), F.lit(feat_c)))),
    ))
    fallback = F.when(health < LOW_HEALTH_BELOW, F.array(_reason(REASON_LOW_HEALTH))) \
        .otherwise(F.array(_reason(REASON_MONITOR)))
    return F.slice(F.when(F.size(fired) == 0, fallback).otherwise(fired), 1, MAX_REASONS)


MEDIAN_COLUMNS = ["segment_median_features", "viewer_segment_median"]


def attention_queue(wh: Warehouse) -> DataFrame:
    """Queue rows with reasons, primary reason and classification,
    plus both segment medians (``MEDIAN_COLUMNS``).

    One median pass serves two rules. The workspace median (W2) leaves rows
    without a segment unmatched. The viewer's copy (A9) treats the null
    segment as a group and missing values as zero, and values are never
    missing here because the summary coalesces them. The medians are one row
    per segment; AQE measures them and broadcasts, so the queue is not
    shuffled for this join.
    """
    base = queue_base(wh)
    medians = segment_median(feature_variety(wh), name="_median").withColumnRenamed("segment", "_median_segment")
    segment = F.col("segment")
    reasons = attention_reasons()
    return (
        base.join(medians, segment.eqNullSafe(F.col("_median_segment")), "left")
        .withColumn("segment_median_features",
                    F.when(segment.isNull(), F.lit(None).cast("double"))
                    .otherwise(F.col("_median")))
        .withColumn("attention_reasons", reasons)
        .select(*QUEUE_COLUMNS, "attention_reasons",
                F.col("attention_reasons")[0]["label"].alias("primary_reason"),
                F.lit("heuristic").alias("signal_classification"),
                "segment_median_features", F.col("_median").alias("viewer_segment_median"))
    )


def ordered_queue(wh: Warehouse) -> DataFrame:
    """Risk desc, revenue desc (account id breaks ties)."""
    return attention_queue(wh).drop(*MEDIAN_COLUMNS).orderBy(*queue_order())


# --- W6-W10: rollups ----------------------------------------------------------

def _attention() -> Column:
    return F.sum(F.when(F.col("churn_risk_band").isin(*ATTENTION_BANDS), 1).otherwise(0))


def portfolio_kpis(wh: Warehouse) -> DataFrame:
    """KPIs with attention accounts (high or already churned)."""
    return queue_base(wh).agg(
        F.count(F.lit(1)).alias("accounts"),
        score_avg("health_score").alias("average_health"),
        score_avg("churn_risk_score").alias("average_churn_risk"),
        money_sum("recognized_revenue").alias("recognized_revenue"),
        _attention().alias("attention_accounts"),
        F.sum(F.when(F.col("lifecycle_stage") == "customer", 1).otherwise(0))
        .alias("active_customers"),
    )


def _rank_small(df: DataFrame, order: list[Column]) -> DataFrame:
    """Rank an aggregate whose rows are one per category value (a few rows)."""
    return df.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def segment_rollup(wh: Warehouse) -> DataFrame:
    """Per segment, by revenue desc."""
    agg = queue_base(wh).groupBy("segment").agg(
        F.count(F.lit(1)).alias("accounts"),
        score_avg("health_score").alias("average_health"),
        score_avg("churn_risk_score").alias("average_churn_risk"),
        money_sum("recognized_revenue").alias("recognized_revenue"),
        _attention().alias("attention_accounts"),
    )
    return _rank_small(agg, [F.col("recognized_revenue").desc(),
                             F.col("segment").asc_nulls_last()])


def lifecycle_rollup(wh: Warehouse) -> DataFrame:
    """Per lifecycle stage, by account count desc."""
    agg = wh.table("mart_customer_health").groupBy("lifecycle_stage").agg(
        F.count(F.lit(1)).alias("accounts"),
        score_avg("health_score").alias("average_health"),
    )
    return _rank_small(agg, [F.col("accounts").desc(), F.col("lifecycle_stage").asc_nulls_last()])


def adoption_listing(wh: Warehouse) -> DataFrame:
    """Segment asc, rate desc nulls last."""
    return _rank_small(wh.table("mart_product_adoption"), [
        F.col("segment").asc_nulls_last(), F.col("adoption_rate").desc_nulls_last(),
        F.col("event_name").asc_nulls_last()])


def retention_listing(wh: Warehouse) -> DataFrame:
    """Revenue desc."""
    return _rank_small(wh.table("mart_revenue_retention"), [
        F.col("recognized_revenue").desc(), F.col("segment").asc_nulls_last(),
        F.col("plan").asc_nulls_last()])


# --- W12-W21: record lists and trends ----------------------------------------

def usage_trend_rows(wh: Warehouse) -> DataFrame:
    """W18 rows: account x month usage."""
    daily = wh.table("fct_product_usage_daily")
    return daily.groupBy("account_id", F.date_format("usage_date", "yyyy-MM").alias("month")).agg(
        F.sum("events").alias("events"),
        F.avg("distinct_features_used").alias("average_features"),
        F.sum("integration_syncs").alias("integration_syncs"),
        F.sum("report_exports").alias("report_exports"),
    )


def revenue_trend_rows(wh: Warehouse) -> DataFrame:
    """W19 rows: account x month revenue."""
    rev = wh.table("fct_subscription_revenue")
    return rev.groupBy("account_id", F.date_format("invoice_date", "yyyy-MM").alias("month")).agg(
        money_sum("recognized_revenue").alias("recognized_revenue"),
        money_sum("failed_invoice_amount").alias("failed_invoice_amount"),
        F.count(F.lit(1)).alias("invoice_count"),
    )


def support_trend_rows(wh: Warehouse) -> DataFrame:
    """W20 rows: account x month support load."""
    t = wh.table("fct_support_tickets")
    return t.groupBy("account_id", F.date_format("ticket_date", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("tickets"),
        F.sum("is_high_priority").alias("high_priority_tickets"),
        exact_avg("resolved_hours").alias("average_resolved_hours"),
    )


# name -> (source frame, date column, limit)
RECORD_LISTS = {
    "crm": (lambda wh: wh.table("dim_accounts"), None, 1),
    "customer": (lambda wh: wh.table("dim_customers"), None, 1),
    "invoices": (lambda wh: wh.table("fct_subscription_revenue"), "invoice_date", 8),
    "support": (lambda wh: wh.table("fct_support_tickets"), "ticket_date", 8),
    "product": (lambda wh: wh.table("stg_product_events"), "event_at", 8),
    "opportunities": (lambda wh: wh.table("fct_pipeline_opportunities"), "created_at", 6),
    "usage": (usage_trend_rows, "month", None),
    "revenue": (revenue_trend_rows, "month", None),
    "support_trend": (support_trend_rows, "month", None),
    "adoption": (lambda wh: wh.table("event_usage_by_account"), None, 12),
}


def record_list(wh: Warehouse, name: str) -> DataFrame:
    """W12-W21 flat: the kept rows per account with their rank ``rn``."""
    source, date_column, limit = RECORD_LISTS[name]
    return ranked_records(source(wh), "account_id", date_column, limit)


# --- workspace summary document -------------------------------------------------

def _section(df: DataFrame, name: str, order: str | None = None) -> DataFrame:
    """One row holding ``df`` as an array of structs (a small, bounded frame),
    in ``order`` when given."""
    cols = [c for c in df.columns if c != order] if order else df.columns
    if order:
        packed = F.sort_array(F.collect_list(F.struct(F.col(order), *[F.col(c) for c in cols])))
        items = F.transform(packed, lambda r: F.struct(*[r[c].alias(c) for c in cols]))
    else:
        items = F.collect_list(F.struct(*[F.col(c) for c in cols]))
    return df.agg(items.alias(name))


def summary_document(wh: Warehouse, audit: DataFrame) -> DataFrame:
    """The workspace's small sections as one row: kpis, segments, lifecycle,
    adoption, retention, quality and source coverage (queue rows and account
    details are large and are written as JSON lines instead).

    Every section is one aggregate row over a frame bounded by the category
    domains (segments, stages, events, plans, checks, sources). They are
    combined by a union and one global aggregate, not by joins."""
    from accounthealth.sources.sinks import audit_document

    kpis = portfolio_kpis(wh)
    sections = [
        kpis.select(F.struct(*kpis.columns).alias("kpis")),
        _section(segment_rollup(wh), "segments", "rank"),
        _section(lifecycle_rollup(wh), "lifecycle", "rank"),
        _section(adoption_listing(wh), "adoption", "rank"),
        _section(retention_listing(wh), "retention", "rank"),
        audit_document(audit).select(F.struct("summary", "checks").alias("quality")),
        _section(source_coverage(wh).withColumn("_o", F.monotonically_increasing_id()),
                 "source_coverage", "_o"),
    ]
    names = [s.columns[0] for s in sections]
    rows = sections[0]
    for sec in sections[1:]:
        rows = rows.unionByName(sec, allowMissingColumns=True)
    return json_safe(rows.agg(*[F.first(n, ignorenulls=True).alias(n) for n in names]))


# --- W22: source coverage ------------------------------------------------------

def source_coverage(wh: Warehouse) -> DataFrame:
    """Row counts (copies included) and date range of each raw source."""
    parts = []
    for label, table, column in COVERAGE_SOURCES:
        ts = F.col(column).cast("timestamp_ntz")
        parts.append(wh.raw(table).agg(
            F.count(F.lit(1)).alias("row_count"), F.min(ts).alias("coverage_start"),
            F.max(ts).alias("coverage_end"),
        ).select(F.lit(label).alias("source"), F.lit(table).alias("table"), "row_count",
                 "coverage_start", "coverage_end"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- W23/W24: per-account detail ---------------------------------------------

def _safe_value(c: Column, kind: T.DataType) -> Column | None:
    """``c`` with NaN and infinities as null at any depth; None if it holds no doubles."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        bad = F.isnan(c) | (F.abs(c) == float("inf"))
        return F.when(~bad, c)
    if isinstance(kind, T.ArrayType):
        if _safe_value(c, kind.elementType) is None:
            return None
        return F.transform(c, lambda x: _safe_value(x, kind.elementType))
    if isinstance(kind, T.StructType):
        parts = {f.name: _safe_value(c.getField(f.name), f.dataType) for f in kind.fields}
        if all(p is None for p in parts.values()):
            return None
        whole = F.struct(*[(c.getField(n) if p is None else p).alias(n) for n, p in parts.items()])
        return F.when(c.isNotNull(), whole)
    return None


def json_safe(df: DataFrame) -> DataFrame:
    """NaN and infinities become null in every double, nested ones too."""
    cols = []
    for field in df.schema.fields:
        safe = _safe_value(F.col(field.name), field.dataType)
        cols.append((F.col(field.name) if safe is None else safe).alias(field.name))
    return df.select(*cols)


def account_lists(wh: Warehouse) -> list[DataFrame]:
    """The ten lists of every account, nested in one grouping: one exchange of the cut records.

    Models bucketed on the account need none: there every list is a frame of its own, nested
    where its rows are, and the lists join bucket by bucket."""
    if wh.buckets:
        return [nest_records(record_list(wh, name), "account_id", name) for name in RECORD_LISTS]
    return [nested_lists({name: (source(wh), date_column, limit)
                          for name, (source, date_column, limit) in RECORD_LISTS.items()})]


def account_detail(wh: Warehouse) -> DataFrame:
    """One row per queue account with its record lists, trends and
    adoption (missing lists are empty arrays)."""
    queue = attention_queue(wh).drop(*MEDIAN_COLUMNS)
    detail = queue.select("account_id", F.struct(*queue.columns).alias("account"))
    for lists in account_lists(wh):
        detail = detail.join(lists, "account_id", "left")

    def lst(name: str) -> Column:
        return F.coalesce(F.col(name), F.array())

    return json_safe(detail.select(
        "account_id", "account",
        F.struct(lst("crm").alias("crm"), lst("customer").alias("customer"),
                 lst("invoices").alias("invoices"), lst("support").alias("support"),
                 lst("product").alias("product"),
                 lst("opportunities").alias("opportunities")).alias("records"),
        F.struct(lst("usage").alias("usage"), lst("revenue").alias("revenue"),
                 lst("support_trend").alias("support")).alias("trends"),
        lst("adoption").alias("adoption"),
    ))


DETAIL_LISTS = {
    "crm_records": "records.crm", "customer_records": "records.customer",
    "invoice_records": "records.invoices", "support_records": "records.support",
    "product_records": "records.product", "opportunity_records": "records.opportunities",
    "usage_months": "trends.usage", "revenue_months": "trends.revenue",
    "support_months": "trends.support", "adoption_features": "adoption",
}


def account_detail_sizes(detail: DataFrame) -> DataFrame:
    """W23 flattened: list lengths per account (for comparison)."""
    return detail.select("account_id", *[F.size(F.col(path)).alias(name)
                                         for name, path in DETAIL_LISTS.items()])


# list -> (its identifying field, a measure); read from the nested document.
DETAIL_FIELDS = {
    "crm": ("records.crm", "account_id", "company_size"),
    "customer": ("records.customer", "customer_id", "company_size"),
    "invoices": ("records.invoices", "invoice_id", "amount"),
    "support": ("records.support", "ticket_id", "resolved_hours"),
    "product": ("records.product", "event_id", None),
    "opportunities": ("records.opportunities", "opportunity_id", "amount"),
    "usage": ("trends.usage", "month", "average_features"),
    "revenue": ("trends.revenue", "month", "recognized_revenue"),
    "support_trend": ("trends.support", "month", "average_resolved_hours"),
    "adoption": ("adoption", "event_name", "events"),
}


def account_detail_records(detail: DataFrame) -> DataFrame:
    """W23 flattened: one row per account, list and position with the record's
    identifying field and a measure."""
    def entries(name: str) -> Column:
        path, key, measure = DETAIL_FIELDS[name]
        return F.transform(F.col(path), lambda r, i: F.struct(
            F.lit(name).alias("list"), (i + 1).cast("int").alias("position"),
            r[key].cast("string").alias("item"),
            (r[measure].cast("double") if measure else F.lit(None).cast("double")).alias("value")))

    every = F.flatten(F.array(*[entries(n) for n in DETAIL_FIELDS]))
    return detail.select("account_id", F.explode(every).alias("e")).select("account_id", "e.*")
