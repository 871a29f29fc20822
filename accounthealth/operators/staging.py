"""Staging: type the raw sources; dedupe accounts.

Casts are ANSI (a bad value fails the build), except ``ended_at`` whose blank
or malformed text becomes null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accounthealth.sources.schemas import STAGED


def _typed(raw: DataFrame, source: str) -> DataFrame:
    return raw.select(*[F.col(c).cast(t).alias(c) for c, t in STAGED[source].items()])


def latest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Keep one row per ``key``: the greatest by ``order`` (desc, nulls last),
    ties broken by the remaining columns (desc, nulls last).

    Expressed as ``max(struct(...))`` per key rather than a ``row_number``
    window: the aggregate combines map-side, so a key that holds a third of
    all rows (a burst of copies) is reduced in every task before the shuffle
    instead of landing whole in one sort.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    best = F.max(F.struct(*[F.col(c) for c in order + rest])).alias("_best")
    return df.groupBy(key).agg(best).select(
        key, *[F.col(f"_best.{c}").alias(c) for c in df.columns if c != key])


def crm_accounts(raw: DataFrame) -> DataFrame:
    """ST1: latest ``created_at`` per account."""
    typed = _typed(raw, "crm_accounts")
    return latest_per_key(typed, "account_id", ["created_at"]).select(*typed.columns)


def crm_contacts(raw: DataFrame) -> DataFrame:
    return _typed(raw, "crm_contacts")


def crm_opportunities(raw: DataFrame) -> DataFrame:
    return _typed(raw, "crm_opportunities")


def billing_subscriptions(raw: DataFrame) -> DataFrame:
    """ST4: ``ended_at`` = try_cast(nullif(text, '') as date)."""
    cols = []
    for c, t in STAGED["billing_subscriptions"].items():
        if c == "ended_at":
            cols.append(F.expr("try_cast(nullif(cast(ended_at as string), '') as date)")
                        .alias("ended_at"))
        else:
            cols.append(F.col(c).cast(t).alias(c))
    return raw.select(*cols)


def billing_invoices(raw: DataFrame) -> DataFrame:
    return _typed(raw, "billing_invoices")


def product_events(raw: DataFrame) -> DataFrame:
    return _typed(raw, "product_events")


def support_tickets(raw: DataFrame) -> DataFrame:
    return _typed(raw, "support_tickets")


def marketing_leads(raw: DataFrame) -> DataFrame:
    return _typed(raw, "marketing_leads")
