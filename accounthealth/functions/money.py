"""Order-independent sums and averages.

A double sum depends on the order rows meet in each task, so two engines (or
two runs with different partitioning) can disagree in the last bits. Money is
summed at six decimals and hours and scores at twelve, more than their values
hold, so the sums are exact and associative; they become doubles once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(28,6)"
WIDE = "decimal(38,12)"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def money_sum(col: Column | str) -> Column:
    """Exact sum of a money column, as double."""
    return F.sum(_c(col).cast(MONEY)).cast("double")


def exact_avg(col: Column | str, decimal_type: str = WIDE) -> Column:
    """Average computed from an exact decimal sum and the non-null count."""
    c = _c(col)
    return F.sum(c.cast(decimal_type)).cast("double") / F.count(c)


def score_avg(col: Column | str) -> Column:
    """Average of 0-100 scores."""
    return exact_avg(col)
