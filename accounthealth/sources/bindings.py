"""Bind the driver's TPC-H-like parquet tables to the eight raw sources.

Each source is a projection/filter/join over ``customer nation region orders
lineitem events`` written with built-in expressions only, so Catalyst pushes
filters and column pruning into the parquet scans. The column rules are the
fixture bindings (see FIXTURES.md part B); the SQL oracle uses the same rules.

Scale notes
- Every source is a narrow projection of one big table plus at most one
  join; ``customer`` joins ``nation``/``region`` (25 and 5 rows by the TPC-H
  spec), which the planner broadcasts from their file size.
- Keys are ``bigint`` throughout: event, invoice and contact keys pass
  2^31 long before 100 TB.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accounthealth.sources.schemas import DRIVER_TABLES

# Fixed values of the bindings (enumerations in the order the rules index them).
SEGMENTS = ["startup", "mid_market", "enterprise"]
LIFECYCLES = ["lead", "trial", "customer", "churned"]
COMPANY_SIZES = [25, 150, 400, 900, 2500]
PLANS_BY_SEGMENT = {"startup": "starter", "mid_market": "growth", "enterprise": "enterprise"}
BASE_MRR_BY_SEGMENT = {"startup": 900, "mid_market": 3500, "enterprise": 12500}
EVENT_NAMES_BY_TYPE = {"view": "dashboard_view", "click": "create_project",
                       "signup": "invite_user", "purchase": "export_report"}
OTHER_EVENT_NAME = "integration_sync"
USER_ROLES = ["admin", "member", "viewer"]
TICKET_CATEGORIES = ["billing", "bug", "how_to", "integration"]
PRIORITIES = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium"}
OTHER_PRIORITY = "low"
TICKET_STATUS = "P"
OPPORTUNITY_STAGES = ["prospecting", "qualified", "proposal", "closed_won", "closed_lost"]
CONTACT_ROLES = ["admin", "buyer", "user", "executive"]
LEAD_SOURCES = ["webinar", "paid_search", "organic", "event", "partner"]


def _pick(index: Column, values: list) -> Column:
    """values[index] for a non-negative integral index (JVM-side array lookup)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _map(col: Column, mapping: dict, default) -> Column:
    expr = None
    for key, value in mapping.items():
        expr = (F.when(col == key, value) if expr is None else expr.when(col == key, value))
    return expr.otherwise(default)


def _days_after(day: str, offset: Column) -> Column:
    return F.date_add(F.lit(day).cast("date"), offset.cast("int"))


class DriverTables:
    """The driver folder as seen by one set of bindings: each table is read
    (file listing, footer) once and shared derivations are built once, so
    every binding that uses them shares the same subtree and Spark can reuse
    its exchanges."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._memo: dict[str, DataFrame] = {}

    def memo(self, name: str, build) -> DataFrame:
        if name not in self._memo:
            self._memo[name] = build()
        return self._memo[name]

    def table(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        return self.memo(name, lambda: self.spark.read.schema(DRIVER_TABLES[name]).parquet(path))


def _distinct_accounts(t: DriverTables) -> DataFrame:
    """One row per customer; ``crm_accounts`` adds exact copies on top."""
    return t.memo("_distinct_accounts", lambda: _build_distinct_accounts(t))


def _customers(t: DriverTables) -> DataFrame:
    """What the customer table alone says of an account (no join)."""
    return t.memo("_customers", lambda: _build_customers(t))


def _build_customers(t: DriverTables) -> DataFrame:
    k = F.col("c_custkey")
    seg_hash = (k * 7919) % 97
    life_hash = (k * 104729) % 89
    return (
        t.table("customer").select(
            k.cast("bigint").alias("account_id"),
            F.col("c_name").alias("account_name"),
            F.col("c_mktsegment").alias("industry"),
            F.col("c_nationkey"),
            F.when(seg_hash < 41, SEGMENTS[0]).when(seg_hash < 78, SEGMENTS[1])
            .otherwise(SEGMENTS[2]).alias("segment"),
            F.when(life_hash < 11, LIFECYCLES[0]).when(life_hash < 23, LIFECYCLES[1])
            .when(life_hash < 82, LIFECYCLES[2]).otherwise(LIFECYCLES[3])
            .alias("lifecycle_stage"),
            F.when(k % 17 == 3, F.lit(None).cast("int"))
            .otherwise(_pick(k % 5, COMPANY_SIZES)).alias("company_size"),
            _days_after("2024-01-01", (k * 31) % 650).alias("created_at"),
        )
    )


def _build_distinct_accounts(t: DriverTables) -> DataFrame:
    nation = t.table("nation").select("n_nationkey", "n_regionkey")
    region = t.table("region").select("r_regionkey", F.col("r_name").alias("region"))
    customers = _customers(t)
    joined = (customers.join(nation, customers.c_nationkey == nation.n_nationkey)
              .join(region, nation.n_regionkey == region.r_regionkey))
    return joined.select("account_id", "account_name", "industry", "region", "segment",
                         "lifecycle_stage", "company_size", "created_at")


def crm_accounts(t: DriverTables) -> DataFrame:
    """One row per account; every hundredth comes twice, from one scan."""
    copies = F.when(F.col("account_id") % 100 == 7, 2).otherwise(1)
    base = _distinct_accounts(t)
    return (base.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies)))
            .select(*base.columns))


def billing_subscriptions(t: DriverTables) -> DataFrame:
    return t.memo("_subscriptions", lambda: _build_subscriptions(t))


def _build_subscriptions(t: DriverTables) -> DataFrame:
    acc = _customers(t).filter(F.col("lifecycle_stage").isin("customer", "churned"))
    k = F.col("account_id").cast("bigint")
    churned = F.col("lifecycle_stage") == "churned"
    ended = (
        F.when(k % 500 == 4, F.lit("2024-01-01"))
        .when(churned, _days_after("2025-03-02", (k * 17) % 390 + (k * 13) % 300).cast("string"))
        .otherwise(F.lit(""))
    )
    base_mrr = _map(F.col("segment"), BASE_MRR_BY_SEGMENT, None)
    return acc.select(
        F.col("account_id").alias("subscription_id"),
        F.col("account_id"),
        _map(F.col("segment"), PLANS_BY_SEGMENT, None).alias("plan"),
        F.when(churned, "canceled").otherwise("active").alias("status"),
        _days_after("2025-01-01", (k * 17) % 390).alias("started_at"),
        ended.alias("ended_at"),
        ((base_mrr * (75 + (k * 13) % 70)).cast("double") / 100).alias("mrr"),
    )


def billing_invoices(t: DriverTables) -> DataFrame:
    orders = t.table("orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    subs = billing_subscriptions(t).select("subscription_id", "account_id")
    k = F.col("o_orderkey")
    return orders.join(subs, orders.o_custkey == subs.account_id).select(
        k.cast("bigint").alias("invoice_id"),
        F.col("subscription_id"),
        F.col("account_id"),
        F.col("o_orderdate").cast("date").alias("invoice_date"),
        F.when(k % 200 == 11, F.lit(-25.0))
        .otherwise(F.col("o_totalprice") / 10).alias("amount"),
        F.when(((k * 7919) % 101 < 4) | (k % 400 == 11), "failed")
        .otherwise("paid").alias("status"),
    )


def product_events(t: DriverTables) -> DataFrame:
    """Every event at its own time. Some events of small accounts have no name, so that the
    segments' feature variety differs."""
    ev = t.table("events").select("event_id", "ts", "user_id", "event_type")
    eid, uid = F.col("event_id"), F.col("user_id")
    account = F.when(eid % 10 < 6, (uid - uid % 10) * 10).otherwise(uid * 10 + eid % 7)
    seg_hash = (account * 7919) % 97
    unnamed = ((eid % 500 == 9) | ((seg_hash < 41) & (eid % 3 == 1))
               | ((seg_hash >= 41) & (seg_hash < 78) & (eid % 5 == 2)))
    return ev.select(
        eid.cast("bigint").alias("event_id"),
        account.cast("bigint").alias("account_id"),
        F.when(unnamed, F.lit(None).cast("string"))
        .otherwise(_map(F.col("event_type"), EVENT_NAMES_BY_TYPE, OTHER_EVENT_NAME))
        .alias("event_name"),
        F.col("ts").alias("event_at"),
        _pick(eid % 3, USER_ROLES).alias("user_role"),
    )


def support_tickets(t: DriverTables) -> DataFrame:
    """Orders in progress are tickets: a predicate the scan takes."""
    orders = t.table("orders").filter(F.col("o_orderstatus") == TICKET_STATUS)
    k = F.col("o_orderkey")
    return orders.select(
        k.cast("bigint").alias("ticket_id"),
        F.col("o_custkey").cast("bigint").alias("account_id"),
        F.col("o_orderdate").alias("created_at"),
        _pick(k % 4, TICKET_CATEGORIES).alias("category"),
        _map(F.col("o_orderpriority"), PRIORITIES, OTHER_PRIORITY).alias("priority"),
        ((1000 + (k * 1009) % 60000).cast("double") / 1000).alias("resolved_hours"),
    )


def crm_opportunities(t: DriverTables) -> DataFrame:
    orders = t.table("orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    k = F.col("o_orderkey")
    created = F.col("o_orderdate").cast("date")
    return orders.select(
        k.cast("bigint").alias("opportunity_id"),
        F.col("o_custkey").cast("bigint").alias("account_id"),
        _pick(k % 5, OPPORTUNITY_STAGES).alias("stage"),
        (F.floor("o_totalprice") / 2).alias("amount"),
        created.alias("created_at"),
        F.date_add(created, ((k * 7) % 300 - 60).cast("int")).alias("closed_at"),
    )


def crm_contacts(t: DriverTables) -> DataFrame:
    """Every distinct order line is a contact of the order's account."""
    items = t.table("lineitem").select("l_orderkey", "l_linenumber").distinct()
    orders = t.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    return items.join(orders, items.l_orderkey == orders.o_orderkey).select(
        (ok * 10 + ln).cast("bigint").alias("contact_id"),
        F.col("o_custkey").cast("bigint").alias("account_id"),
        _pick((ok + ln) % 4, CONTACT_ROLES).alias("role"),
        (ln == 1).alias("is_primary"),
        F.col("o_orderdate").cast("date").alias("created_at"),
    )


def marketing_leads(t: DriverTables) -> DataFrame:
    acc = _customers(t)
    k = F.col("account_id").cast("bigint")
    return acc.select(
        F.col("account_id").alias("lead_id"),
        F.col("account_id"),
        _pick(k % 5, LEAD_SOURCES).alias("source"),
        (15 + (k * 29) % 85).cast("int").alias("score"),
        _days_after("2025-01-01", (k * 23) % 460).alias("created_at"),
        (F.col("lifecycle_stage").isin("customer", "churned") & (k % 4 != 0)).alias("converted"),
    )


BINDINGS = {
    "crm_accounts": crm_accounts,
    "crm_contacts": crm_contacts,
    "crm_opportunities": crm_opportunities,
    "billing_subscriptions": billing_subscriptions,
    "billing_invoices": billing_invoices,
    "product_events": product_events,
    "support_tickets": support_tickets,
    "marketing_leads": marketing_leads,
}


class LazySources(Mapping):
    """The eight raw sources, each built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._tables, self._built = DriverTables(spark, sf_dir), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = BINDINGS[name](self._tables)
        return self._built[name]

    def __iter__(self):
        return iter(BINDINGS)

    def __len__(self) -> int:
        return len(BINDINGS)


def load(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """All eight raw sources as lazy DataFrames over the driver tables."""
    return LazySources(spark, sf_dir)
