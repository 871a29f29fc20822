"""Connected components of a distributed edge list by alternating stars.

Each round links every node's larger neighbours to its smallest neighbour and
then every node's smaller neighbours likewise; the edge list ends as stars
around each component's smallest node. Rounds are written to the shared folder,
so the lineage stays short; only a row count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accounthealth.llm.frames import staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        "a", F.least("a", "m").alias("m"))
    # larger neighbours only: the hub's own edges shrink to one a neighbour
    return (both.filter("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(
        F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node) for every node on an edge of ``a, b``."""
    now = staged(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        now = staged(_small_star(_large_star(now)), "edges")
        last, mark = mark, _mark(now)
        if mark == last:
            break
    return (now.groupBy("a").agg(F.min("b").alias("component"))
            .select(F.col("a").alias("node"), "component")
            .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component"))
                         .distinct()))
