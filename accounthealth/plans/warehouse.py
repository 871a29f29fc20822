"""The model DAG as lazy DataFrames.

``Warehouse`` holds the eight raw sources and hands out every model by name.
Each model is built once per ``Warehouse`` (memoised), so all readers of a
model share one logical subtree and Spark can reuse its exchanges. Nothing
runs until an action; ``build`` materialises the requested models as tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accounthealth.operators import dims, facts, marts, staging
from accounthealth.sources import bindings, csv_source

# (layer, model, builder) in the fixed build order.
MODELS: list[tuple[str, str, Callable[["Warehouse"], DataFrame]]] = [
    ("staging", "stg_crm_accounts", lambda w: staging.crm_accounts(w.raw("crm_accounts"))),
    ("staging", "stg_crm_contacts", lambda w: staging.crm_contacts(w.raw("crm_contacts"))),
    ("staging", "stg_crm_opportunities",
     lambda w: staging.crm_opportunities(w.raw("crm_opportunities"))),
    ("staging", "stg_billing_subscriptions",
     lambda w: staging.billing_subscriptions(w.raw("billing_subscriptions"))),
    ("staging", "stg_billing_invoices",
     lambda w: staging.billing_invoices(w.raw("billing_invoices"))),
    ("staging", "stg_product_events", lambda w: staging.product_events(w.raw("product_events"))),
    ("staging", "stg_support_tickets",
     lambda w: staging.support_tickets(w.raw("support_tickets"))),
    ("staging", "stg_marketing_leads",
     lambda w: staging.marketing_leads(w.raw("marketing_leads"))),
    ("dimensions", "dim_accounts", lambda w: dims.dim_accounts(w.table("stg_crm_accounts"))),
    ("dimensions", "dim_customers",
     lambda w: dims.dim_customers(w.table("dim_accounts"), w.table("stg_billing_subscriptions"))),
    ("dimensions", "dim_plans", lambda w: dims.dim_plans(w.spark)),
    ("dimensions", "dim_date", lambda w: dims.dim_date(w.spark)),
    ("facts", "fct_product_usage_daily",
     lambda w: facts.fct_product_usage_daily(w.table("stg_product_events"))),
    ("facts", "fct_subscription_revenue",
     lambda w: facts.fct_subscription_revenue(w.table("stg_billing_invoices"))),
    ("facts", "fct_support_tickets",
     lambda w: facts.fct_support_tickets(w.table("stg_support_tickets"))),
    ("facts", "fct_pipeline_opportunities",
     lambda w: facts.fct_pipeline_opportunities(w.table("stg_crm_opportunities"))),
    ("marts", "mart_account_summary",
     lambda w: marts.mart_account_summary(
         w.table("dim_accounts"), w.table("latest_subscription"),
         w.table("fct_product_usage_daily"), w.table("fct_subscription_revenue"),
         w.table("fct_support_tickets"))),
    ("marts", "mart_customer_health",
     lambda w: marts.mart_customer_health(w.table("mart_account_summary"))),
    ("marts", "mart_churn_risk", lambda w: marts.mart_churn_risk(w.table("mart_customer_health"))),
    ("marts", "mart_revenue_retention",
     lambda w: marts.mart_revenue_retention(w.table("mart_customer_health"))),
    ("marts", "mart_product_adoption",
     lambda w: marts.mart_product_adoption(w.table("stg_product_events"),
                                           w.table("dim_accounts"))),
]

# Shared intermediate frames (not models of their own).
HELPERS: dict[str, Callable[["Warehouse"], DataFrame]] = {
    "latest_subscription": lambda w: dims.latest_subscription(w.table("stg_billing_subscriptions")),
    "scored_accounts": lambda w: marts.scored_accounts(w.table("mart_customer_health")),
    "event_usage_by_account": lambda w: marts.event_usage_by_account(w.table("stg_product_events")),
    "mart_segment_adoption": lambda w: marts.mart_segment_adoption(
        w.table("mart_product_adoption"), w.table("dim_accounts")),
}

MODEL_NAMES = [name for _, name, _ in MODELS]
LAYER = {name: layer for layer, name, _ in MODELS}
_BUILDERS = {name: fn for _, name, fn in MODELS} | HELPERS


class Warehouse:
    """Lazy model context over eight raw source DataFrames."""

    def __init__(self, spark: SparkSession, sources: Mapping[str, DataFrame]):
        self.spark = spark
        self.sources = sources
        self._tables: dict[str, DataFrame] = {}
        self._bound: set[str] = set()
        # audit check -> value, as counted while the models were written
        self.observed: dict[str, int] = {}
        # buckets on account_id of the written models, if they have any
        self.buckets: int | None = None

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str) -> "Warehouse":
        """Sources bound to the driver's parquet tables."""
        return cls(spark, bindings.load(spark, sf_dir))

    @classmethod
    def from_csv(cls, spark: SparkSession, raw_dir: str) -> "Warehouse":
        """Sources read from ``<raw_dir>/<source>.csv`` files."""
        return cls(spark, csv_source.load(spark, raw_dir))

    def raw(self, source: str) -> DataFrame:
        return self.sources[source]

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            if name not in _BUILDERS:
                raise KeyError(f"unknown model {name!r}")
            self._tables[name] = _BUILDERS[name](self)
        return self._tables[name]

    def built_on(self, name: str, source: str, raw: DataFrame) -> DataFrame:
        """Model ``name`` built on ``raw`` in place of its raw source."""
        return _BUILDERS[name](Warehouse(self.spark, {source: raw}))

    def bind(self, name: str, df: DataFrame) -> None:
        """Replace a model by an equivalent frame (e.g. its written table).

        Models that were built lazily before are forgotten, so those that read
        ``name`` are built again on the bound frame."""
        self._bound.add(name)
        self._tables = {k: v for k, v in self._tables.items() if k in self._bound} | {name: df}

    def is_bound(self, name: str) -> bool:
        return name in self._bound

    def manifest(self, names: list[str] | None = None) -> DataFrame:
        """(layer, table, rows) for the requested models, ordered by name."""
        frames = [
            self.table(n).agg(F.count(F.lit(1)).alias("rows"))
            .select(F.lit(LAYER[n]).alias("layer"), F.lit(n).alias("table"), "rows")
            for n in sorted(names or MODEL_NAMES)
        ]
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out
