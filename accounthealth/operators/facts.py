"""Facts: daily product usage, invoice revenue, tickets, pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HIGH_PRIORITIES = ["high", "urgent"]


def fct_product_usage_daily(stg_events: DataFrame) -> DataFrame:
    """per account and day: events, distinct non-null names, and three
    filtered counts.

    Plan: the distinct count is split by Catalyst into a map-side partial
    aggregate on (account, day, name) and a final count, so a hot account
    is combined in every task before it is shuffled.
    """
    name = F.col("event_name")
    return (
        stg_events.groupBy("account_id", F.col("event_at").cast("date").alias("usage_date"))
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.count_distinct(name).alias("distinct_features_used"),
            F.count_if(name == "integration_sync").alias("integration_syncs"),
            F.count_if(name == "export_report").alias("report_exports"),
            F.count_if(name.isNull()).alias("null_event_names"),
        )
    )


def fct_subscription_revenue(stg_invoices: DataFrame) -> DataFrame:
    """invoice grain with recognized and failed amounts."""
    amount, status = F.col("amount"), F.col("status")
    return stg_invoices.select(
        "invoice_id", "subscription_id", "account_id", "invoice_date", "amount", "status",
        F.when((status == "paid") & (amount > 0), amount).otherwise(F.lit(0.0))
        .alias("recognized_revenue"),
        F.when(status == "failed", amount).otherwise(F.lit(0.0)).alias("failed_invoice_amount"),
    )


def fct_support_tickets(stg_tickets: DataFrame) -> DataFrame:
    """ticket grain with date and high-priority flag."""
    return stg_tickets.select(
        "ticket_id", "account_id",
        F.col("created_at").cast("date").alias("ticket_date"),
        "category", "priority", "resolved_hours",
        F.when(F.col("priority").isin(*HIGH_PRIORITIES), 1).otherwise(0)
        .alias("is_high_priority"),
    )


def fct_pipeline_opportunities(stg_opps: DataFrame) -> DataFrame:
    """opportunity grain with won and lost amounts."""
    stage, amount = F.col("stage"), F.col("amount")
    return stg_opps.select(
        "opportunity_id", "account_id", "stage", "amount", "created_at", "closed_at",
        F.when(stage == "closed_won", amount).otherwise(F.lit(0.0)).alias("won_amount"),
        F.when(stage == "closed_lost", amount).otherwise(F.lit(0.0)).alias("lost_amount"),
    )
