"""Schemas of the eight raw sources.

``RAW_TEXT`` reads a CSV source as text: the staging layer does every cast
(strict ANSI ``cast``, so one bad value fails the build, as in the model
contract). ``STAGED`` documents the typed result of staging.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Column order per source, as the source files are written.
COLUMNS: dict[str, list[str]] = {
    "crm_accounts": ["account_id", "account_name", "industry", "region", "segment",
                     "lifecycle_stage", "company_size", "created_at"],
    "crm_contacts": ["contact_id", "account_id", "role", "is_primary", "created_at"],
    "crm_opportunities": ["opportunity_id", "account_id", "stage", "amount",
                          "created_at", "closed_at"],
    "billing_subscriptions": ["subscription_id", "account_id", "plan", "status",
                              "started_at", "ended_at", "mrr"],
    "billing_invoices": ["invoice_id", "subscription_id", "account_id", "invoice_date",
                         "amount", "status"],
    "product_events": ["event_id", "account_id", "event_name", "event_at", "user_role"],
    "support_tickets": ["ticket_id", "account_id", "created_at", "category", "priority",
                        "resolved_hours"],
    "marketing_leads": ["lead_id", "account_id", "source", "score", "created_at",
                        "converted"],
}

SOURCE_NAMES: list[str] = list(COLUMNS)

_I, _S, _D, _F, _B = T.IntegerType(), T.StringType(), T.DateType(), T.DoubleType(), T.BooleanType()
# Surrogate ids are 64-bit: at warehouse scale event and invoice ids exceed 2^31.
_ID = T.LongType()
_TS = T.TimestampNTZType()

# Typed result of the staging casts.
STAGED: dict[str, dict[str, T.DataType]] = {
    "crm_accounts": {"account_id": _ID, "account_name": _S, "industry": _S, "region": _S,
                     "segment": _S, "lifecycle_stage": _S, "company_size": _I,
                     "created_at": _D},
    "crm_contacts": {"contact_id": _ID, "account_id": _ID, "role": _S, "is_primary": _B,
                     "created_at": _D},
    "crm_opportunities": {"opportunity_id": _ID, "account_id": _ID, "stage": _S,
                          "amount": _F, "created_at": _D, "closed_at": _D},
    "billing_subscriptions": {"subscription_id": _ID, "account_id": _ID, "plan": _S,
                              "status": _S, "started_at": _D, "ended_at": _D, "mrr": _F},
    "billing_invoices": {"invoice_id": _ID, "subscription_id": _ID, "account_id": _ID,
                         "invoice_date": _D, "amount": _F, "status": _S},
    "product_events": {"event_id": _ID, "account_id": _ID, "event_name": _S,
                       "event_at": _TS, "user_role": _S},
    "support_tickets": {"ticket_id": _ID, "account_id": _ID, "created_at": _TS,
                        "category": _S, "priority": _S, "resolved_hours": _F},
    "marketing_leads": {"lead_id": _ID, "account_id": _ID, "source": _S, "score": _I,
                        "created_at": _D, "converted": _B},
}


def raw_text_schema(source: str) -> T.StructType:
    """All-text schema for reading a CSV source without type inference."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in COLUMNS[source]])


# Columns the bindings read from the driver's parquet tables, with their
# stored types. Reading with an explicit schema skips footer inference on the
# driver and asks the scan for exactly these columns.
DRIVER_TABLES: dict[str, T.StructType] = {
    "customer": T.StructType([T.StructField("c_custkey", T.LongType()),
                              T.StructField("c_name", T.StringType()),
                              T.StructField("c_nationkey", T.IntegerType()),
                              T.StructField("c_mktsegment", T.StringType())]),
    "nation": T.StructType([T.StructField("n_nationkey", T.IntegerType()),
                            T.StructField("n_regionkey", T.IntegerType())]),
    "region": T.StructType([T.StructField("r_regionkey", T.IntegerType()),
                            T.StructField("r_name", T.StringType())]),
    "orders": T.StructType([T.StructField("o_orderkey", T.LongType()),
                            T.StructField("o_custkey", T.LongType()),
                            T.StructField("o_orderstatus", T.StringType()),
                            T.StructField("o_totalprice", T.DoubleType()),
                            T.StructField("o_orderdate", T.TimestampNTZType()),
                            T.StructField("o_orderpriority", T.StringType())]),
    "lineitem": T.StructType([T.StructField("l_orderkey", T.LongType()),
                              T.StructField("l_linenumber", T.IntegerType())]),
    "events": T.StructType([T.StructField("event_id", T.LongType()),
                            T.StructField("ts", T.TimestampNTZType()),
                            T.StructField("user_id", T.LongType()),
                            T.StructField("event_type", T.StringType())]),
}
