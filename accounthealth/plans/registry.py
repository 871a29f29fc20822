"""Registry of named queries: a Spark builder and its SQL oracle per key."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from accounthealth.plans.oracle import with_prefix
from accounthealth.plans.warehouse import Warehouse


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[Warehouse], DataFrame]
    sql: str | None  # None: no SQL form; checked against a brute-force test instead

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Warehouse.from_testdata(spark, sf_dir))


REGISTRY: dict[str, Query] = {}


def register(key: str, sql: str | None = None):
    """Register ``fn(wh) -> DataFrame`` under ``key`` with its oracle body."""

    def deco(fn: Callable[[Warehouse], DataFrame]):
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key!r}")
        REGISTRY[key] = Query(key, fn, with_prefix(sql) if sql else None)
        return fn

    return deco


def all_queries() -> dict[str, Query]:
    # Importing the catalogue modules fills the registry.
    from accounthealth.plans import catalog  # noqa: F401

    return REGISTRY
