"""accounthealth: account-health analytics as Spark DataFrame plans.

Layers (each a module of pure ``f(wh) -> DataFrame`` functions):

- ``sources``   raw source readers (driver parquet bindings, CSV) and sinks
- ``operators`` staging, dimensions, facts, marts, quality, reports,
                workspace and queue operators
- ``functions`` shared column helpers (exact money sums, number/label text,
                top-n per key)
- ``plans``     the model DAG (``Warehouse``), query registry and the SQL
                oracle used by the correctness gate
"""

from accounthealth.plans.warehouse import Warehouse

__all__ = ["Warehouse"]
