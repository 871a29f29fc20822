"""Data-quality audit (Q1-Q12).

Each check is a declarative spec: which frame it reads and one aggregate
expression for its observed value. The audit groups the specs by frame,
computes one aggregate per frame (every raw source is scanned once, however
many checks read it), unpivots with ``stack`` and derives status and detail
with column expressions. Raw-side checks read the raw sources, not staging.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accounthealth.functions.dates import lenient_timestamp
from accounthealth.plans.warehouse import Warehouse

# Accepted lifecycle stages.
ACCEPTED_LIFECYCLES = ["lead", "trial", "customer", "churned"]


@dataclass(frozen=True)
class Check:
    position: int
    name: str
    severity: str          # critical -> fail, warning -> warn
    threshold: int
    detail: str            # "{}" is replaced by the observed value
    frame: str             # key of FRAMES
    observed: Callable[[], Column]
    fails_when_zero: bool = False


def _duplicates() -> Column:
    # Rows repeating an earlier id; all null ids count as one value.
    key = F.col("account_id").cast("bigint")
    return (F.count(F.lit(1)) - F.count_distinct(key)
            - F.coalesce(F.max(F.when(key.isNull(), 1).otherwise(0)), F.lit(0)))


FRAMES: dict[str, Callable[[Warehouse], DataFrame]] = {
    "crm_accounts": lambda wh: wh.raw("crm_accounts"),
    "billing_invoices": lambda wh: wh.raw("billing_invoices"),
    "billing_subscriptions": lambda wh: wh.raw("billing_subscriptions"),
    "product_events": lambda wh: wh.raw("product_events"),
    # Health rows with their risk columns: the churn mart is a projection of
    # the same rows, so the three mart checks share one aggregate (one pass
    # over the health chain instead of two).
    "scored_accounts": lambda wh: wh.table("scored_accounts"),
    # Revenue rows whose account is not modeled (anti join, null ids included).
    # Counted per account first, so a hot account is one row before the join.
    "revenue_orphans": lambda wh: wh.table("fct_subscription_revenue")
    .groupBy("account_id").agg(F.count(F.lit(1)).alias("n"))
    .join(wh.table("dim_accounts").select("account_id"), "account_id", "left_anti"),
}


def _out_of_bounds(col: str) -> Column:
    return F.count_if((F.col(col) < 0) | (F.col(col) > 100))


# Check names, severities, thresholds and detail texts, in audit order.
CHECKS: list[Check] = [
    Check(1, "duplicate_crm_accounts", "critical", 0,
          "{} duplicate account_id values found in CRM accounts.",
          "crm_accounts", _duplicates),
    Check(2, "missing_company_size", "warning", 0,
          "{} CRM accounts are missing company_size.",
          "crm_accounts", lambda: F.count_if(F.col("company_size").isNull())),
    Check(3, "accepted_lifecycle_values", "critical", 0,
          "{} accounts have invalid lifecycle_stage values.",
          "crm_accounts",
          lambda: F.count_if(~F.coalesce(F.col("lifecycle_stage").isin(*ACCEPTED_LIFECYCLES),
                                         F.lit(False)))),
    Check(4, "negative_invoice_amount", "critical", 0,
          "{} invoices have negative amount values.",
          "billing_invoices", lambda: F.count_if(F.col("amount").cast("double") < 0)),
    Check(5, "subscription_end_before_start", "critical", 0,
          "{} subscriptions end before they start.",
          "billing_subscriptions",
          lambda: F.count_if(lenient_timestamp(F.col("ended_at"))
                             < lenient_timestamp(F.col("started_at")))),
    Check(6, "null_product_event_names", "warning", 0,
          "{} product events have null event_name.",
          "product_events", lambda: F.count_if(F.col("event_name").isNull())),
    Check(7, "mart_customer_health_rows", "critical", 1,
          "{} customer health rows built.",
          "scored_accounts", lambda: F.count(F.lit(1)), fails_when_zero=True),
    Check(8, "churn_score_bounds", "critical", 0,
          "{} churn scores outside 0-100.",
          "scored_accounts", lambda: _out_of_bounds("churn_risk_score")),
    Check(9, "health_score_bounds", "critical", 0,
          "{} health scores outside 0-100.",
          "scored_accounts", lambda: _out_of_bounds("health_score")),
    Check(10, "revenue_account_relationship", "critical", 0,
          "{} revenue rows lack a valid account.",
          "revenue_orphans", lambda: F.coalesce(F.sum("n"), F.lit(0))),
]

CHECK_BY_NAME = {c.name: c for c in CHECKS}


# --- metrics that a build observes while it writes (no distinct counts among them)

RAW_METRICS: dict[str, dict[str, Callable[[], Column]]] = {
    "crm_accounts": {"rows": lambda: F.count(F.lit(1)),
                     "missing_company_size": CHECK_BY_NAME["missing_company_size"].observed,
                     "accepted_lifecycle_values":
                         CHECK_BY_NAME["accepted_lifecycle_values"].observed},
    "billing_invoices": {"negative_invoice_amount":
                         CHECK_BY_NAME["negative_invoice_amount"].observed},
    "billing_subscriptions": {"subscription_end_before_start":
                              CHECK_BY_NAME["subscription_end_before_start"].observed},
    "product_events": {"null_product_event_names":
                       CHECK_BY_NAME["null_product_event_names"].observed},
}

BUILT_METRICS: dict[str, dict[str, Callable[[], Column]]] = {
    "mart_customer_health": {"health_score_bounds": CHECK_BY_NAME["health_score_bounds"].observed},
    "mart_churn_risk": {"churn_score_bounds": CHECK_BY_NAME["churn_score_bounds"].observed},
}


def observed_checks(metrics: dict[str, int]) -> dict[str, int]:
    """Check values from a build's metrics (``<source or model>.<metric>``)."""
    out = {key.split(".")[1]: value for key, value in metrics.items()
           if key.split(".")[1] in CHECK_BY_NAME}
    if "mart_customer_health.rows" in metrics:
        out["mart_customer_health_rows"] = metrics["mart_customer_health.rows"]
    if {"crm_accounts.rows", "stg_crm_accounts.rows"} <= set(metrics):
        # staging keeps one row an identifier, null among them
        out["duplicate_crm_accounts"] = (metrics["crm_accounts.rows"]
                                         - metrics["stg_crm_accounts.rows"])
    return out


def audit(wh: Warehouse, names: list[str] | None = None) -> DataFrame:
    """Q11: one row per check (all ten by default). Checks that the warehouse has observed
    while it was written are not counted again."""
    wanted = [CHECK_BY_NAME[n] for n in names] if names else CHECKS
    frames: dict[str, list[Check]] = {}
    for check in wanted:
        known = check.name in wh.observed
        frames.setdefault("observed" if known else check.frame, []).append(check)

    parts = []
    for frame, checks in frames.items():
        if frame == "observed":
            agg = wh.spark.range(1).select(*[
                F.lit(wh.observed[c.name]).cast("bigint").alias(f"o{c.position}") for c in checks])
        else:
            agg = FRAMES[frame](wh).agg(*[c.observed().cast("bigint").alias(f"o{c.position}")
                                          for c in checks])
        cells = []
        for c in checks:
            pre, post = c.detail.split("{}")
            cells += [F.lit(c.position), F.lit(c.name), F.lit(c.severity), F.lit(c.threshold),
                      F.lit(pre), F.lit(post), F.lit(c.fails_when_zero), F.col(f"o{c.position}")]
        parts.append(agg.select(F.stack(F.lit(len(checks)), *cells).alias(
            "position", "name", "severity", "threshold", "pre", "post", "zero_fails",
            "observed")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)

    observed = F.col("observed")
    failing = F.when(F.col("zero_fails"), observed == 0).otherwise(observed > 0)
    status = (F.when(failing & (F.col("severity") == "critical"), "fail")
              .when(failing, "warn").otherwise("pass"))
    return rows.select(
        "position", "name", status.alias("status"), "severity", "observed", "threshold",
        F.concat(F.col("pre"), observed.cast("string"), F.col("post")).alias("detail"),
    )


def summary(audit_rows: DataFrame) -> DataFrame:
    """Q12: counts by status; overall fail > warn > pass."""
    s = F.col("status")
    agg = audit_rows.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(s == "pass").alias("passed"),
        F.count_if(s == "warn").alias("warnings"),
        F.count_if(s == "fail").alias("failed"),
    )
    return agg.withColumn(
        "status",
        F.when(F.col("failed") > 0, "fail").when(F.col("warnings") > 0, "warn").otherwise("pass"),
    )
