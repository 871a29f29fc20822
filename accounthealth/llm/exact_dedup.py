"""Exact dedup by content sort (built-in functions only).

Texts are range-partitioned by their first characters and a hash of the whole, so
the sampled splitters that the driver sees are of bounded size. The external
sort of each partition brings equal texts together, and the window over the
sorted rows compares neighbouring texts in full to find the runs. Nothing of the
input is left out and no digest decides equality inside a run.

Hot texts: a text that holds at least one row in ``1 / hot_share`` is dealt to
``salts`` sub-runs by a hash of its identifier, so that the range partitioner
can split it. There are at most ``hot_share`` such texts, which bounds the two
broadcast frames (their fingerprints, and their merged sub-runs).

Defined results: a null text equals the empty text. A null identifier never
stays before a non-null one. Rows that repeat an identifier are rows of their
own: each counts in ``group_size`` and each copy that holds the kept
identifier is marked kept. Other columns pass through in ``row``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accounthealth.llm.frames import packed, quoted, text_or_empty

HOT_SHARE = 1000
SALTS = 64
HEAD = 32  # characters of a text that the splitters hold


def content_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   keep: str = "max", hot_share: int = HOT_SHARE,
                   salts: int = SALTS) -> DataFrame:
    """One row per input row: ``id, row, text, text_null, keep_id, group_size, text_sha256,
    stays``.

    ``keep`` names the identifier that stays, ``"max"`` or ``"min"``; ``row``
    holds every column but the identifier and the text. ``stays`` marks one row of each
    group: of those with the kept identifier the first by the hash of its other columns,
    then by those columns themselves.
    """
    if keep not in ("max", "min"):
        raise ValueError(f"keep must be 'max' or 'min', not {keep!r}")
    best = F.max if keep == "max" else F.min
    rows = df.select(
        F.col(quoted(id_col)).alias("id"),
        text_or_empty(quoted(text_col)).alias("text"),
        F.col(quoted(text_col)).isNull().alias("text_null"),
        packed(df, id_col, text_col).alias("row"),
    ).withColumn("print", F.xxhash64("text"))

    total = max(1, df.count())
    hot = (rows.groupBy("print").agg(F.count(F.lit(1)).alias("n"))
           .filter((F.col("n") > 1) & (F.col("n") * hot_share >= total))
           .select("print", F.lit(True).alias("hot")))
    dealt = rows.join(F.broadcast(hot), "print", "left").withColumn(
        "salt", F.when(F.col("hot"), F.pmod(F.xxhash64("id", "row"), F.lit(salts)).cast("int"))
        .otherwise(-1)).drop("hot")

    # The range partitioning already clusters the window's keys, so the window only sorts.
    dealt = dealt.withColumn("begin", F.substring("text", 1, HEAD))
    run = Window.partitionBy("begin", "print", "text", "salt")
    order = F.desc_nulls_last if keep == "max" else F.asc_nulls_last
    first = run.orderBy(order("id"), "other", F.to_json(F.struct("row")))
    runs = (dealt.repartitionByRange("begin", "print", "salt")
            .withColumn("other", F.xxhash64("row"))
            .withColumn("run_keep", best("id").over(run))
            .withColumn("run_size", F.count(F.lit(1)).over(run))
            .withColumn("nth", F.row_number().over(first))
            .withColumn("text_sha256", F.sha2("text", 256)))
    # Every member of a sub-run carries the run's size: dividing by it counts
    # the sub-run once. At most hot_share groups, salts rows each.
    merged = (runs.filter("salt >= 0")
              .groupBy("text_sha256", "salt")
              .agg(best("run_keep").alias("run_keep"), F.max("run_size").alias("run_size"),
                   F.min(F.when(F.col("nth") == 1, F.col("other"))).alias("other"))
              .groupBy("text_sha256")
              .agg(best("run_keep").alias("hot_keep"), F.sum("run_size").alias("hot_size"),
                   F.collect_list(F.struct("run_keep", "other", "salt")).alias("subs"),
                   F.lit(True).alias("is_hot")))
    subs = F.filter("subs", lambda x: x["run_keep"].eqNullSafe(F.col("hot_keep")))
    merged = merged.withColumn("hot_salt", F.array_min(F.transform(
        subs, lambda x: F.struct(x["other"].alias("other"), x["salt"].alias("salt"))))["salt"])
    out = runs.withColumn("hot_sha", F.when(F.col("salt") >= 0, F.col("text_sha256")))
    out = out.join(F.broadcast(merged.drop("subs").withColumnRenamed("text_sha256", "hot_sha")),
                   "hot_sha", "left")
    return out.select(
        "id", "row", "text", "text_null", "text_sha256",
        F.when(F.col("is_hot"), F.col("hot_keep")).otherwise(F.col("run_keep")).alias("keep_id"),
        F.when(F.col("is_hot"), F.col("hot_size")).otherwise(F.col("run_size"))
        .alias("group_size"),
        ((F.col("nth") == 1) & (F.col("is_hot").isNull() | (F.col("hot_salt") == F.col("salt"))))
        .alias("stays"),
    )


def op5_exact_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    groups = content_groups(docs, keep="max")
    return groups.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


OP5_SQL = """
SELECT doc_id,
       max(doc_id) OVER g AS keep_id,
       count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


def unique_documents(docs: DataFrame, keep: str = "max") -> DataFrame:
    """The documents that stay, with the columns of ``docs``: one row per text."""
    first = content_groups(docs, keep=keep).filter("stays")
    text = F.when(~F.col("text_null"), F.col("text"))
    return first.select(*[
        F.col("id").alias(c) if c == "doc_id" else text.alias(c) if c == "text"
        else F.col("row").getField(c).alias(c) for c in docs.columns])
