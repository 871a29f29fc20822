"""Queue search over a stored index (A1) instead of a scan of the queue.

The index is a table of postings: one row per account and distinct run of
``GRAM`` characters of its searchable text, in folders by a checksum of the run.
A query reads only the folders and row groups of its own runs, keeps the accounts
that have all of them, and verifies the substring on those accounts alone. The
result is that of the scan; a query shorter than a run has no postings and is
a scan.
"""

from __future__ import annotations

from zlib import crc32

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accounthealth.operators.explorer import search, searchable_text

GRAM = 3
BUCKETS = 64
SPREAD = 8  # files of one folder, so that a frequent run is not one task's


def grams_of(text: Column) -> Column:
    """The distinct runs of ``GRAM`` characters of a text (none in a shorter one)."""
    ends = F.length(text) - (GRAM - 1)
    return F.when(ends > 0, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(ends, F.lit(1))),
        lambda k: F.substring(text, k, GRAM)))).otherwise(F.array().cast("array<string>"))


def query_grams(query: str) -> list[str]:
    q = query.strip().lower()
    return sorted({q[k:k + GRAM] for k in range(len(q) - GRAM + 1)})


def write_index(queue: DataFrame, path: str, key: str = "account_id") -> None:
    """Writes the postings of the queue's rows under ``path``."""
    rows = queue.select(key, F.explode(grams_of(searchable_text())).alias("gram"))
    rows = rows.distinct().withColumn("bucket", (F.crc32(F.col("gram")) % BUCKETS).cast("int"))
    (rows.repartition("bucket", F.pmod(F.xxhash64(key), F.lit(SPREAD)))
     .sortWithinPartitions("bucket", "gram", key)
     .write.mode("overwrite").partitionBy("bucket").parquet(path))


def candidates(spark: SparkSession, path: str, query: str,
               key: str = "account_id") -> DataFrame | None:
    """Accounts that hold every run of the query; None for a query shorter than a run."""
    grams = query_grams(query)
    if not grams:
        return None
    buckets = sorted({crc32(g.encode()) % BUCKETS for g in grams})
    found = spark.read.parquet(path).filter(F.col("bucket").isin(buckets)
                                            & F.col("gram").isin(grams))
    return found.groupBy(key).agg(F.count(F.lit(1)).alias("_grams")).filter(
        F.col("_grams") == len(grams)).select(key)


def indexed_search(queue: DataFrame, path: str, query: str, key: str = "account_id") -> DataFrame:
    """A1 over the index at ``path``: the rows that ``explorer.search`` gives."""
    some = candidates(queue.sparkSession, path, query, key)
    return search(queue if some is None else queue.join(some, key, "left_semi"), query)
