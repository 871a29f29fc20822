"""Exact grouped median by radix selection, without gathering a group into one task.

A plain ``percentile``/``median`` aggregate merges every distinct value of a
group into one buffer on one task; a group holding a third of the data puts
all its distinct values there. Here the median is found digit by digit:

1. count rows per (group, value): a map-side combined aggregate;
2. write each value as an unsigned number that sorts like the value (the bits
   of the double, negative ones turned over) in three digits of 22, 21 and
   21 bits;
3. count rows per (group, first digit); running totals over the digits of a
   group give the digits that hold its two middle ranks;
4. keep the values with those digits and do the same with the next digit,
   then with the last, which leaves the two middle values themselves.

A running total sees at most one row per digit of a group, 2**22, however many
values there are and however they crowd: values that share a digit beside a
far outlier are told apart by the next one.

The result is exact and interpolated like ``median``: the mean of the two
middle values (equal for an odd count). Null and NaN values are ignored (as
pandas' median does) and a null group is a group, as in ``groupBy``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGIT_BITS = (22, 21, 21)


def sortable_bits(value: Column) -> Column:
    """A long whose unsigned order is the order of the doubles."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value).cast("long")
    return F.when(bits < 0, F.bitwise_not(bits)).otherwise(
        bits.bitwiseXOR(F.lit(-(1 << 63))))


def digits(value: Column) -> list[Column]:
    """The digits of a double, the first one first; compared in turn they sort like it."""
    out, below = [], 64
    for bits in DIGIT_BITS:
        below -= bits
        out.append(F.shiftrightunsigned(sortable_bits(value), below)
                   .bitwiseAND(F.lit((1 << bits) - 1)))
    return out


def _holding(rows: DataFrame, keys: list[str], digit: str) -> DataFrame:
    """Of ``rows`` (keys, digit, _n, and the wanted rank _k), the digit that holds the rank, with
    the rank inside it."""
    running = Window.partitionBy(*keys).orderBy(digit).rowsBetween(Window.unboundedPreceding, 0)
    ended = rows.withColumn("_end", F.sum("_n").over(running))
    start = F.col("_end") - F.col("_n")
    return ended.filter((start <= F.col("_k")) & (F.col("_k") < F.col("_end"))).withColumn(
        "_k", F.col("_k") - start).drop("_end", "_n")


def grouped_median(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """One row per ``group`` with the exact median of ``value`` as ``name``."""
    g, v = "_g", "_v"
    counts = (df.select(F.col(group).alias(g), F.col(value).cast("double").alias(v))
              .filter(F.col(v).isNotNull() & ~F.isnan(v))
              .groupBy(g, v).agg(F.count(F.lit(1)).alias("_n")))
    cols = [f"_d{k}" for k in range(len(DIGIT_BITS))]
    counts = counts.select(g, v, "_n", *[d.alias(c) for c, d in zip(cols, digits(F.col(v)),
                                                                  strict=True)])

    # The first digit, for both middle ranks at once: one row a group and digit.
    firsts = counts.groupBy(g, cols[0]).agg(F.sum("_n").alias("_n"))
    total = F.sum("_n").over(Window.partitionBy(g))
    middle = F.explode(F.array(F.struct(F.lit(1).alias("which"), F.expr("(_total - 1) div 2").alias("k")),
                               F.struct(F.lit(2).alias("which"), F.expr("_total div 2").alias("k"))))
    running = Window.partitionBy(g).orderBy(cols[0]).rowsBetween(Window.unboundedPreceding, 0)
    firsts = (firsts.withColumn("_total", total).withColumn("_end", F.sum("_n").over(running))
              .withColumn("_m", middle))
    start = F.col("_end") - F.col("_n")
    held = firsts.filter((start <= F.col("_m.k")) & (F.col("_m.k") < F.col("_end"))).select(
        F.col(g).alias("_hg"), F.col(cols[0]).alias("_h0"), F.col("_m.which").alias("_which"),
        (F.col("_m.k") - start).alias("_k"))

    rows = counts.join(held, F.col(g).eqNullSafe(F.col("_hg"))
                       & (F.col(cols[0]) == F.col("_h0"))).drop("_hg", "_h0")
    for nth, digit in enumerate(cols[1:], 1):
        last = nth == len(cols) - 1
        keys = [g, "_which"]
        per_digit = rows.groupBy(*keys, "_k", digit).agg(
            F.sum("_n").alias("_n"), *([F.max(v).alias(v)] if last else []))
        held = _holding(per_digit, keys, digit)
        if last:  # all digits are known: one value is left for each rank
            return held.groupBy(g).agg(
                (F.max(F.when(F.col("_which") == 1, F.col(v))) * 0.5
                 + F.max(F.when(F.col("_which") == 2, F.col(v))) * 0.5).alias(name)
            ).withColumnRenamed(g, group)
        held = held.select(F.col(g).alias("_hg"), F.col("_which").alias("_hw"),
                           F.col(digit).alias("_hd"), F.col("_k").alias("_hk"))
        rows = rows.join(held, F.col(g).eqNullSafe(F.col("_hg")) & (F.col("_which") == F.col("_hw"))
                         & (F.col(digit) == F.col("_hd"))).drop("_hg", "_hw", "_hd", "_k") \
            .withColumnRenamed("_hk", "_k")
