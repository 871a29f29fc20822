"""Exact running totals in a global order, without a task that holds a group.

Rows are range-partitioned by (group, order) and written, so that a lost
executor cannot move a border. One count a (partition, group) gives what lies
before each partition; a window inside the partition does the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accounthealth.llm.frames import quoted, staged


def running(rows: DataFrame, group: list[str], order: list[str],
            value: str | None = None) -> DataFrame:
    """``rows`` with ``before`` (the total of ``value`` over the earlier rows of the group, or
    their number) and ``whole`` (the group's). Equal rows go in any one order, so that the
    range partitioning can split even rows that repeat; group columns must not be null."""
    taken = {*rows.columns, "_row", "_at", "_part"}
    if len(taken) != len(rows.columns) + 3:
        raise ValueError("the rows have columns of this function's names")
    keys = [F.col(quoted(c)) for c in [*group, *order]]
    numbered = staged(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")
    dealt = numbered.repartitionByRange(*keys, "_row").sortWithinPartitions(*keys, "_row")
    dealt = staged(dealt.withColumn("_at", F.monotonically_increasing_id()), "order")
    dealt = dealt.withColumn("_part", F.shiftright("_at", 33))  # the id's upper bits

    one = F.col(quoted(value)) if value else F.lit(1)
    parts = dealt.groupBy(*group, "_part").agg(F.sum(one).alias("_sum"))
    ahead = Window.partitionBy(*group).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    parts = parts.select(*group, "_part",
                         F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_ahead"),
                         F.sum("_sum").over(Window.partitionBy(*group)).alias("whole"))
    inside = Window.partitionBy(*group, "_part").orderBy("_at").rowsBetween(
        Window.unboundedPreceding, -1)
    own = dealt.withColumn("_own", F.coalesce(F.sum(one).over(inside), F.lit(0)))
    return own.join(parts, [*group, "_part"]).select(
        *[quoted(c) for c in rows.columns], (F.col("_ahead") + F.col("_own")).alias("before"),
        "whole")
