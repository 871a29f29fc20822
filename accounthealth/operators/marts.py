"""Marts: account summary, health, churn risk, retention, adoption.

Every per-account input is aggregated to one row per ``account_id`` before it
is joined (aggregate-then-join), so the joins are one-to-one, cannot fan
out, and all sides arrive hash-partitioned on ``account_id``: the sort-merge
chain reuses that partitioning instead of shuffling again. AQE turns any
side that measures small at runtime into a broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accounthealth.functions.cache import per_context
from accounthealth.functions.money import exact_avg, money_sum

SUMMARY_COLUMNS = [
    "account_id", "account_name", "industry", "region", "segment", "lifecycle_stage",
    "company_size", "plan", "subscription_status", "total_events", "avg_daily_features",
    "recognized_revenue", "failed_invoice_amount", "support_tickets",
    "high_priority_tickets", "avg_resolved_hours",
]

RISK_COLUMNS = ["account_id", "account_name", "segment", "region", "lifecycle_stage", "plan",
                "health_score", "churn_risk_score", "churn_risk_band"]


def usage_by_account(usage_daily: DataFrame) -> DataFrame:
    """M1: total events and mean daily feature variety per account."""
    return usage_daily.groupBy("account_id").agg(
        F.sum("events").alias("total_events"),
        F.avg("distinct_features_used").alias("avg_daily_features"),
    )


def revenue_by_account(revenue: DataFrame) -> DataFrame:
    """M2: exact recognized and failed sums per account."""
    return revenue.groupBy("account_id").agg(
        money_sum("recognized_revenue").alias("recognized_revenue"),
        money_sum("failed_invoice_amount").alias("failed_invoice_amount"),
    )


def support_by_account(tickets: DataFrame) -> DataFrame:
    """M3: ticket count, high-priority count, mean resolution hours."""
    hours = F.col("resolved_hours")
    return tickets.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("support_tickets"),
        F.sum("is_high_priority").alias("high_priority_tickets"),
        exact_avg(hours).alias("avg_resolved_hours"),
    )


def mart_account_summary(dim_acc: DataFrame, latest_sub: DataFrame, usage_daily: DataFrame,
                         revenue: DataFrame, tickets: DataFrame) -> DataFrame:
    """M4: one row per account, missing activity as zero.

    ``latest_sub`` is the per-account reduction behind ``dim_customers``;
    joining it directly equals joining ``dim_customers`` (one row per account,
    same keys) without reading the accounts twice.
    """
    subs = latest_sub.select("account_id", "plan", F.col("status").alias("subscription_status"))
    joined = (
        dim_acc.join(subs, "account_id", "left")
        .join(usage_by_account(usage_daily), "account_id", "left")
        .join(revenue_by_account(revenue), "account_id", "left")
        .join(support_by_account(tickets), "account_id", "left")
    )
    zero = {"total_events": 0, "avg_daily_features": 0.0, "recognized_revenue": 0.0,
            "failed_invoice_amount": 0.0, "support_tickets": 0, "high_priority_tickets": 0,
            "avg_resolved_hours": 0.0}
    return joined.select(*[
        F.coalesce(F.col(c), F.lit(zero[c])).alias(c) if c in zero else F.col(c)
        for c in SUMMARY_COLUMNS
    ])


@per_context
def health_score_expr() -> Column:
    """M5: clamp 0..100 of the additive health rule (terms in rule order)."""
    c = F.col
    raw = (
        F.lit(45)
        + F.least(c("total_events") / 25, F.lit(25))
        + F.least(c("recognized_revenue") / 25000, F.lit(15))
        - F.least(c("support_tickets") * 4, F.lit(20))
        - F.least(c("high_priority_tickets") * 8, F.lit(20))
        - F.when(c("failed_invoice_amount") > 0, 12).otherwise(0)
        - F.when(c("lifecycle_stage") == "churned", 35).otherwise(0)
    )
    return F.least(F.lit(100), F.greatest(F.lit(0), raw))


@per_context
def churn_risk_score_expr() -> Column:
    """M6: clamp 0..100 of inverted health plus billing, support, churn terms."""
    c = F.col
    raw = (
        F.lit(100) - c("health_score")
        + F.when(c("failed_invoice_amount") > 0, 12).otherwise(0)
        + F.least(c("high_priority_tickets") * 5, F.lit(20))
        + F.when(c("lifecycle_stage") == "churned", 40).otherwise(0)
    )
    return F.least(F.lit(100), F.greatest(F.lit(0), raw))


@per_context
def churn_risk_band_expr() -> Column:
    """M7: band from lifecycle and 100 - health (not from the risk score)."""
    inverse = F.lit(100) - F.col("health_score")
    return (
        F.when(F.col("lifecycle_stage") == "churned", "already_churned")
        .when(inverse >= 55, "high")
        .when(inverse >= 35, "medium")
        .otherwise("low")
    )


def mart_customer_health(summary: DataFrame) -> DataFrame:
    return summary.withColumn("health_score", health_score_expr())


def scored_accounts(health: DataFrame) -> DataFrame:
    """Health rows with the risk score and band added (health joined to
    risk on ``account_id`` is this frame minus null-id rows)."""
    return (health.withColumn("churn_risk_score", churn_risk_score_expr())
            .withColumn("churn_risk_band", churn_risk_band_expr()))


def mart_churn_risk(health: DataFrame) -> DataFrame:
    return scored_accounts(health).select(*RISK_COLUMNS)


def mart_revenue_retention(health: DataFrame) -> DataFrame:
    """M8: per segment and plan (null plan is its own group): gross revenue
    retention = 1 - churned revenue / revenue, null when revenue <= 0."""
    churned_rev = F.when(F.col("lifecycle_stage") == "churned", F.col("recognized_revenue")) \
        .otherwise(F.lit(0.0))
    agg = health.groupBy("segment", "plan").agg(
        F.count(F.lit(1)).alias("accounts"),
        money_sum("recognized_revenue").alias("recognized_revenue"),
        money_sum(churned_rev).alias("churned_revenue"),
    )
    total, churned = F.col("recognized_revenue"), F.col("churned_revenue")
    return agg.withColumn(
        "gross_revenue_retention",
        F.when(total > 0, F.lit(1) - churned / total).otherwise(F.lit(None).cast("double")),
    )


def event_usage_by_account(stg_events: DataFrame) -> DataFrame:
    """Per account and named event: count, first and last time.

    Shared by M9/M10 and W21. Aggregating events before they meet the
    accounts keeps a hot account to a handful of rows per task, so the join
    that follows cannot skew.
    """
    return (
        stg_events.filter(F.col("event_name").isNotNull())
        .groupBy("account_id", "event_name")
        .agg(F.count(F.lit(1)).alias("events"),
             F.min("event_at").alias("first_seen"),
             F.max("event_at").alias("last_seen"))
    )


def mart_product_adoption(stg_events: DataFrame, dim_acc: DataFrame) -> DataFrame:
    """M9: per segment and event: events, distinct adopting accounts, rate.

    As modeled, the rate divides distinct adopting accounts by distinct
    accounts of the same joined rows, so it is 1.0 for every group; kept for
    parity (``mart_segment_adoption`` carries the documented meaning).
    Each (account, event) pair is one pre-aggregated row, so the distinct
    count is a plain count.
    """
    per_account = event_usage_by_account(stg_events).select("account_id", "event_name", "events")
    adopting = F.count(F.lit(1))
    return (
        per_account.join(dim_acc.select("account_id", "segment"), "account_id")
        .groupBy("segment", "event_name")
        .agg(F.sum("events").alias("events"), adopting.alias("adopting_accounts"))
        .withColumn("adoption_rate",
                    F.col("adopting_accounts").cast("double")
                    / F.nullif(F.col("adopting_accounts"), F.lit(0)))
    )


def mart_segment_adoption(adoption: DataFrame, dim_acc: DataFrame) -> DataFrame:
    """Adopting accounts / modeled accounts in the segment.

    Segment counts are one row per segment; the planner broadcasts them
    after measuring.
    """
    seg = dim_acc.groupBy(F.col("segment").alias("_segment")).agg(
        F.count(F.lit(1)).alias("segment_accounts"))
    return (
        adoption.select("segment", "event_name", "events", "adopting_accounts")
        .join(seg, F.col("segment").eqNullSafe(F.col("_segment")))
        .select("segment", "event_name", "events", "adopting_accounts", "segment_accounts",
                (F.col("adopting_accounts").cast("double")
                 / F.nullif(F.col("segment_accounts"), F.lit(0))).alias("segment_adoption_rate"))
    )
