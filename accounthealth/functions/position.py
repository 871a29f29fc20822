"""The position of every row in a total order, without a task that sees all rows.

Rows are range-partitioned and sorted; the rows of each partition are counted
(one row a partition) and the counts of the partitions before are added to a
row's place in its own. The sorted rows are checkpointed in the shared folder
first, as the range borders come from a sample and both steps need the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accounthealth.session import ensure_checkpoint_dir


def with_position(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``df`` with the 1-based position ``name`` (bigint). ``order`` should end in a unique
    key; rows it leaves equal get positions of their own in any order."""
    ensure_checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # upper bits: the partition, in range order; lower 33 bits: the row's place in it
    ranged = ranged.withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    ranged = ranged.withColumn("_part", F.shiftright("_at", 33))
    # one row a partition: the window's input does not grow with the rows
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return ranged.join(counts, "_part").select(
        *df.columns, (F.col("_before") + place).alias(name))
