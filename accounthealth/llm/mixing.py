"""Mixing sources to target weights (built-in functions only).

Every document gets a hash-random key. Within its source the documents are
range-sorted by that key; word counts are summed per (source, key range), a
small window over those sums gives the words before each range, and a window
inside each range finishes the prefix sum. The mix takes ``epochs`` whole
passes of a source and then cuts the sorted stream at its exact budget.

A hot source is split over ``2 ** RANGE_BITS`` key ranges, so no task holds a
source. Only the table of sources (one row each) meets in one task, for ranks
and targets.

Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating, and
share 150 % of all words; a target stops at twice its source's words and the
excess goes to the others by weight (the level that fills the rest is found in
closed form over the sources sorted by cap / weight).

Defined results: null or empty texts count 0 words and take 0; a null source
is a source of its own; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accounthealth.llm.frames import packed, quoted, staged, word_count

WEIGHTS = (5, 2, 1)
SHARE = (3, 2)  # 150 % of all words
MAX_EPOCHS = 2
RANGE_BITS = 12
KEY_BITS = 60


def _source_key(col):
    """Non-null key in code-point order with null last."""
    return F.coalesce(F.concat(F.lit("s"), col), F.lit("t"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``src, source_size`` (one row per source) -> with ``target`` (double)."""
    num, den = share
    scale = math.lcm(*weights)
    every = Window.partitionBy().orderBy("src")
    whole = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          F.pmod(F.row_number().over(every) - 1, F.lit(len(weights))) + 1)
    frame = sizes.withColumn("weight", weight.cast("long"))
    frame = frame.withColumn("order", F.expr(f"source_size * {scale} div weight"))
    first = Window.partitionBy().orderBy("order", "src")
    before = first.rowsBetween(Window.unboundedPreceding, -1)
    frame = (frame
             .withColumn("nth", F.row_number().over(first))
             .withColumn("caps", F.coalesce(F.sum("source_size").over(before), F.lit(0))
                         * max_epochs)
             .withColumn("left_weight", F.sum("weight").over(whole)
                         - F.coalesce(F.sum("weight").over(before), F.lit(0)))
             .withColumn("all_words", F.sum("source_size").over(whole)))
    wide = "decimal(38,0)"
    # num / den * all words, less the caps before, times den: exact integers
    spare = (F.col("all_words").cast(wide) * num - F.col("caps").cast(wide) * den)
    frame = frame.withColumn("spare", spare.cast(wide))
    fits = (F.col("spare") * F.col("weight")
            <= F.col("source_size").cast(wide) * F.col("left_weight") * (max_epochs * den))
    frame = frame.withColumn("level_at", F.min(F.when(fits, F.col("nth"))).over(whole))
    at = F.col("nth") == F.col("level_at")
    frame = (frame
             .withColumn("level_spare", F.max(F.when(at, F.col("spare"))).over(whole))
             .withColumn("level_weight", F.max(F.when(at, F.col("left_weight"))).over(whole)))
    target = F.when(
        F.col("nth") < F.col("level_at"), (F.col("source_size") * max_epochs).cast("double")
    ).otherwise((F.col("level_spare").cast("long") * F.col("weight")).cast("double")
                / (F.col("level_weight") * den).cast("double"))
    return frame.select("src", "source_size", target.alias("target"))


def mix(df: DataFrame, id_col: str = "doc_id", source_col: str = "source",
        text_col: str = "text", seed: str = "mix", carry: bool = False) -> DataFrame:
    """One row per document: ``id, size, source_size, target, before, epochs, rest, taken``.

    ``before`` counts the words of the source's documents that sort earlier,
    ``epochs`` the whole passes, ``rest`` the budget of the last, partial pass;
    ``taken`` are the words the mix takes of the document, cut exactly at the
    budget. ``carry`` adds ``row`` (all columns) for callers that need them.
    """
    ident = F.coalesce(F.col(quoted(id_col)).cast("string"), F.lit(""))
    digest = F.substring(F.md5(F.concat(F.lit(seed + ":"), ident)), 1, KEY_BITS // 4)
    docs = df.select(
        F.col(quoted(id_col)).alias("id"),
        _source_key(F.col(quoted(source_col))).alias("src"),
        word_count(quoted(text_col)).alias("size"),
        F.conv(digest, 16, 10).cast("long").alias("key"),
        F.xxhash64(F.col(quoted(text_col))).alias("tie"),
        *([packed(df).alias("row")] if carry else []),
    ).withColumn("slot", F.shiftright("key", KEY_BITS - RANGE_BITS).cast("int"))

    if not carry:  # a few numbers a document: the texts are counted once
        docs = staged(docs, "mix-sizes")
    narrow = docs.select("src", "slot", "size")
    slots = narrow.groupBy("src", "slot").agg(F.sum("size").alias("slot_size"))
    ahead = Window.partitionBy("src").orderBy("slot").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = slots.select(
        "src", "slot", F.coalesce(F.sum("slot_size").over(ahead), F.lit(0)).alias("offset"))
    targets = source_targets(slots.groupBy("src").agg(F.sum("slot_size").alias("source_size")))
    plan = offsets.join(targets, "src")

    inside = (Window.partitionBy("src", "slot").orderBy("key", "id", "size", "tie")
              .rowsBetween(Window.unboundedPreceding, -1))
    sorted_docs = docs.repartitionByRange("src", "slot").withColumn(
        "inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    out = sorted_docs.join(plan, ["src", "slot"])
    budget = F.floor("target").cast("long")
    out = (out.withColumn("before", F.col("offset") + F.col("inner"))
           .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(
               budget / F.col("source_size"))).otherwise(0).cast("long"))
           .withColumn("rest", budget - F.col("epochs") * F.col("source_size")))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))
    return out.select(
        "id", "size", "source_size", "target", "before", "epochs", "rest",
        (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"),
        *(["row"] if carry else []))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: one row per pass.

    Whole documents only: a document whose first word lies inside the last
    pass's budget comes once more, whole.
    """
    picked = mix(docs, carry=True)
    times = F.col("epochs") + F.when(F.col("before") < F.col("rest"), 1).otherwise(0)
    rows = picked.select("row", F.explode(F.array_repeat(F.lit(1), times.cast("int"))).alias("pass"))
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix(docs).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


# The oracle reaches the targets by the rounds the contract describes (share by
# weight, cap, share the excess again) instead of the closed form.
OP8_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS key
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS BIGINT) AS weight
  FROM docs GROUP BY source
), rounds AS (
  SELECT 0 AS nth, source, source_size, weight, false AS capped FROM sources
  UNION ALL
  SELECT nth + 1, source, source_size, weight,
         capped OR (3 * total - 4 * caps) * weight > 4 * source_size * open_weight
  FROM (
    SELECT *, sum(source_size) OVER () AS total,
           coalesce(sum(source_size) FILTER (capped) OVER (), 0) AS caps,
           coalesce(sum(weight) FILTER (NOT capped) OVER (), 0) AS open_weight
    FROM rounds
  ) WHERE nth < (SELECT count(*) FROM sources)
), settled AS (
  SELECT *, sum(source_size) OVER () AS total,
         coalesce(sum(source_size) FILTER (capped) OVER (), 0) AS caps,
         coalesce(sum(weight) FILTER (NOT capped) OVER (), 0) AS open_weight
  FROM rounds WHERE nth = (SELECT count(*) FROM sources)
), targets AS (
  SELECT source, source_size,
         CASE WHEN capped THEN CAST(2 * source_size AS DOUBLE)
              ELSE CAST((3 * total - 4 * caps) * weight AS DOUBLE) / CAST(2 * open_weight AS DOUBLE)
         END AS target
  FROM settled
), placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0
            ELSE (budget // source_size) * size
                 + greatest(0, least(size, budget % source_size - before))
       END::BIGINT AS taken
FROM placed
"""
