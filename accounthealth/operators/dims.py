"""Dimensions: accounts, customers, plans, calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accounthealth.operators.staging import latest_per_key

ACCOUNT_COLUMNS = ["account_id", "account_name", "industry", "region", "segment",
                   "lifecycle_stage", "company_size", "created_at"]

# The plan catalogue (plan, base monthly revenue, description).
PLANS = [
    ("starter", 900, "SMB self-serve plan"),
    ("growth", 3500, "Mid-market growth plan"),
    ("enterprise", 12500, "Enterprise contract plan"),
]

# The calendar spine, both ends inclusive.
DATE_SPINE_START = "2025-01-01"
DATE_SPINE_END = "2026-12-31"


def dim_accounts(stg_accounts: DataFrame) -> DataFrame:
    """D1."""
    return stg_accounts.select(*ACCOUNT_COLUMNS)


def latest_subscription(stg_subscriptions: DataFrame) -> DataFrame:
    """Latest subscription per account: ``started_at`` desc nulls last, then
    ``subscription_id`` desc. One row per account, reduced before any join."""
    subs = stg_subscriptions.select("account_id", "started_at", "subscription_id",
                                    "plan", "status")
    return latest_per_key(subs, "account_id", ["started_at", "subscription_id"])


def dim_customers(dim_acc: DataFrame, stg_subscriptions: DataFrame) -> DataFrame:
    """Account left-joined to its latest subscription.

    The subscriptions are reduced to one row per account first, so the join
    is one-to-one and needs no post-join window.
    """
    latest = latest_subscription(stg_subscriptions)
    return dim_acc.join(latest, "account_id", "left").select(
        F.col("account_id").alias("customer_id"),
        "account_id", "account_name", "industry", "region", "segment",
        "lifecycle_stage", "company_size", "plan",
        F.col("status").alias("subscription_status"),
        F.col("started_at").alias("customer_since"),
    )


def dim_plans(spark: SparkSession) -> DataFrame:
    """D3: literal plan catalogue (a JVM-side literal relation)."""
    rows = [F.struct(F.lit(plan).alias("plan"), F.lit(base).cast("int").alias("base_mrr"),
                     F.lit(text).alias("description")) for plan, base, text in PLANS]
    return spark.range(1).select(F.inline(F.array(*rows)))


def dim_date(spark: SparkSession) -> DataFrame:
    """One row per day of the spine with year, month, quarter start."""
    day = F.col("date_day")
    return (
        spark.range(1)
        .select(F.explode(F.sequence(F.lit(DATE_SPINE_START).cast("date"),
                                     F.lit(DATE_SPINE_END).cast("date"),
                                     F.expr("interval 1 day"))).alias("date_day"))
        .select(day, F.year(day).alias("year"), F.month(day).alias("month"),
                F.trunc(day, "quarter").alias("quarter_start"))
    )
