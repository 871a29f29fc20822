"""Filter interaction audit over every order of the filters.

Each document becomes a mask of the filters it fails. In one order of the
filters it is removed at the step of the first filter of its mask. Orders are
numbered lexicographically; a number is the sum of the order's Lehmer digits
times factorials, so all orders with one prefix are an interval of numbers. The
orders in which a mask is removed at step k begin with k - 1 filters outside
the mask and one inside it: a few intervals. Each group of documents of one
mask adds its count at the start of these intervals and takes it off at their
ends, and one prefix sum over the numbers gives the documents removed at every
step of every order.

The documents are read once; all after that works on (part, mask) counts, at
most 2 ** filters rows a part. The rows of one text meet after they have been
counted by (text, part, labels, identifier), in aggregates that combine before
their shuffle.

Defined results: a null text is empty and a null part the empty string. Equal
texts are compared by SHA-256. A document without an identifier neither is nor
has a smaller copy and has no labels; rows that repeat the smallest identifier
of a text all pass the copy filter. Labels that repeat an identifier count as
set if one row sets them. An empty table has no parts and gives no rows.
"""

from __future__ import annotations

import math
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accounthealth.llm.frames import quoted, staged, text_or_empty

FILTERS = "ABCDE"
# Fixed by the contract: the limits of the filters.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 50, 65, 5
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SIGNS = r"[#$%&*|]"
GAP = r"[\x20\x09-\x0D]+"


# ---- orders

def lehmer_rank(prefix: tuple[int, ...], n: int) -> int:
    """Number of the first order of 0..n-1 that begins with ``prefix``."""
    rank = 0
    for at, k in enumerate(prefix):
        digit = k - sum(p < k for p in prefix[:at])
        rank += digit * math.factorial(n - 1 - at)
    return rank


def removals(n: int) -> list[tuple[int, int, int, int]]:
    """``(mask, step, rank, change)``: the ends of the intervals of order numbers in which
    the documents of a mask are removed at a step (1 begins one, -1 ends one)."""
    ends: dict[tuple[int, int, int], int] = {}
    for step in range(1, n + 1):
        for prefix in permutations(range(n), step):
            start = lehmer_rank(prefix, n)
            stop = start + math.factorial(n - step)
            others = [k for k in range(n) if k not in prefix]
            for chosen in range(1 << len(others)):
                mask = 1 << prefix[-1] | sum(1 << k for j, k in enumerate(others)
                                             if chosen >> j & 1)
                for rank, change in ((start, 1), (stop, -1)):
                    at = (mask, step, rank)
                    ends[at] = ends.get(at, 0) + change
    return [(*at, change) for at, change in sorted(ends.items()) if change]


# ---- documents

def content_bits(text: Column) -> Column:
    """Bits of the filters that look at one text alone, A to D."""
    words = F.array_remove(F.split(text, GAP, -1), "")
    count, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    fails = [count < LEAST_WORDS,
             F.lit(100) * distinct < F.lit(LEAST_DISTINCT) * count,
             capitals.cast("long") * 100 > F.length(text).cast("long") * MOST_CAPITALS,
             text.rlike(SIGNS)]
    bits = F.lit(0)
    for k, fail in enumerate(fails):
        bits = bits + F.when(fail, 1 << k).otherwise(0)
    return bits


def label_flags(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``lid, good, toxic`` for every labelled identifier."""
    flag = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0))
    return (labels.filter(F.col(quoted(id_col)).isNotNull())
            .groupBy(F.col(quoted(id_col)).alias("lid"))
            .agg(flag("quality").alias("good"), flag("toxic").alias("toxic")))


def mask_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``part, mask, n, good, toxic``: documents of a part by the filters they fail, and how
    many of them are labelled good and toxic."""
    body = text_or_empty(quoted(text_col))
    ident = F.col(quoted(id_col))
    rows = docs.select(
        ident.alias("id"), F.coalesce(F.col(quoted(part_col)), F.lit("")).alias("part"),
        content_bits(body).alias("bits"), F.unhex(F.sha2(body, 256)).alias("content"))
    # Rows without an identifier match no label; spread, they do not meet in one task.
    rows = rows.withColumn("spread", F.when(F.col("id").isNull(), F.xxhash64("content"))
                           .otherwise(F.lit(0)))
    flags = label_flags(labels, id_col).withColumn("zero", F.lit(0).cast("long"))
    known = rows.join(flags, (F.col("id") == F.col("lid"))
                      & (F.col("spread") == F.col("zero")), "left")
    known = known.select("id", "part", "bits", "content",
                         F.coalesce("good", F.lit(0)).alias("good"),
                         F.coalesce("toxic", F.lit(0)).alias("toxic"))

    kind = ["content", "part", "bits", "good", "toxic"]
    by_id = known.groupBy(*kind, "id").agg(F.count(F.lit(1)).alias("n"))
    named = F.col("id").isNotNull()
    groups = staged(by_id.groupBy(*kind).agg(
        F.sum("n").alias("n"), F.sum(F.when(~named, F.col("n")).otherwise(0)).alias("unnamed"),
        F.min(F.when(named, F.struct("id", "n"))).alias("least")), "audit-groups")
    heads = groups.groupBy("content").agg(F.min("least.id").alias("head"))
    first = F.when(F.col("least.id") == F.col("head"), F.col("least.n")).otherwise(0)
    # The only filter that looks at other rows is the last one.
    copies = groups.join(heads, "content").withColumn("passed", F.col("unnamed") + first)
    sides = F.explode(F.array(
        F.struct(F.col("bits").alias("mask"), F.col("passed").alias("n")),
        F.struct((F.col("bits") + (1 << (len(FILTERS) - 1))).alias("mask"),
                 (F.col("n") - F.col("passed")).alias("n"))))
    split = copies.select("part", "good", "toxic", sides.alias("side")).filter("side.n > 0")
    return split.groupBy("part", F.col("side.mask").alias("mask")).agg(
        F.sum("side.n").alias("n"), F.sum(F.expr("side.n * good")).alias("good"),
        F.sum(F.expr("side.n * toxic")).alias("toxic"))


# ---- audit

COUNTS = ("n", "good", "toxic")


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley`` from ``part, mask, n, good, toxic``."""
    spark, n = counts.sparkSession, len(filters)
    orders = math.factorial(n)
    # Both tables depend on the number of filters alone: broadcast, of fixed size.
    ends = F.broadcast(spark.createDataFrame(removals(n),
                                             "mask int, step int, rank int, change int"))
    names = F.broadcast(spark.createDataFrame(
        [(lehmer_rank(p, n), step + 1, "".join(filters[k] for k in p), p[step])
         for p in permutations(range(n)) for step in range(n)],
        "rank int, step int, filter_order string, nth int"))

    bit = lambda k: F.col("mask").bitwiseAND(F.lit(1 << k)) != 0
    number = lambda when: F.sum(F.when(when, F.col("n")).otherwise(0))
    parts = counts.groupBy("part").agg(
        F.sum("n").alias("whole"),
        F.array(*[number(bit(k)) for k in range(n)]).alias("fails"),
        F.array(*[number(F.col("mask") == 1 << k) for k in range(n)]).alias("alone"))

    changes = counts.join(ends, "mask").select(
        "part", "step", "rank", *[(F.col(c) * F.col("change")).alias(c) for c in COUNTS])
    grid = parts.select("part", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step")).select(
        "part", "step", F.explode(F.sequence(F.lit(0), F.lit(orders - 1))).alias("rank"),
        *[F.lit(0).cast("long").alias(c) for c in COUNTS])
    steps = changes.unionByName(grid).groupBy("part", "step", "rank").agg(
        *[F.sum(c).alias(c) for c in COUNTS])
    along = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(
        Window.unboundedPreceding, 0)
    steps = steps.select("part", "step", "rank", *[F.sum(c).over(along).alias(c) for c in COUNTS])
    # The end of the last interval lies behind the last order.
    steps = steps.filter(F.col("rank") < orders)

    down = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(
        Window.unboundedPreceding, 0)
    same = Window.partitionBy("part", "nth")
    pick = lambda c: F.element_at(c, F.col("nth") + 1)
    rows = steps.withColumn("gone", F.sum("n").over(down)).join(names, ["rank", "step"])
    return rows.join(parts, "part").select(
        "part", "filter_order", "step", (F.col("whole") - F.col("gone")).alias("kept"),
        F.col("n").alias("removed"), (pick("fails") - F.col("n")).alias("redundant"),
        pick("alone").alias("unique_fails"), F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"), F.sum("n").over(same).alias("shapley"))


def op13_filter_audit(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return audit(mask_counts(docs, labels))


# The oracle looks at every order by itself: a document falls at the first of its
# failing filters. Counts by flags, no intervals.
OP13_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), flags AS (
  SELECT part, doc_id, len(words) < 50 AS a,
         100 * len(list_distinct(words)) < 65 * len(words) AS b,
         100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 5 * length(body) AS c,
         regexp_matches(body, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY body), false) AS e
  FROM docs
), known AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic
  FROM labels GROUP BY doc_id
), kinds AS (
  SELECT part, a, b, c, d, e, count(*) AS n,
         coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM flags LEFT JOIN known USING (doc_id) GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT v.l || w.l || x.l || y.l || z.l AS filter_order
  FROM letters v, letters w, letters x, letters y, letters z
  WHERE len(list_distinct([v.l, w.l, x.l, y.l, z.l])) = 5
), falls AS (
  SELECT part, filter_order, n, good, toxic,
         list_min([CASE WHEN a THEN strpos(filter_order, 'A') ELSE 6 END,
                   CASE WHEN b THEN strpos(filter_order, 'B') ELSE 6 END,
                   CASE WHEN c THEN strpos(filter_order, 'C') ELSE 6 END,
                   CASE WHEN d THEN strpos(filter_order, 'D') ELSE 6 END,
                   CASE WHEN e THEN strpos(filter_order, 'E') ELSE 6 END]) AS step
  FROM kinds, orders
), fails AS (
  SELECT part, l,
         coalesce(sum(n) FILTER (CASE l WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c
                                        WHEN 'D' THEN d ELSE e END), 0) AS failing,
         coalesce(sum(n) FILTER (a = (l = 'A') AND b = (l = 'B') AND c = (l = 'C')
                                 AND d = (l = 'D') AND e = (l = 'E')), 0) AS alone
  FROM kinds, letters GROUP BY part, l
), every AS (
  SELECT p.part, filter_order, step, substr(filter_order, step::INT, 1) AS l
  FROM (SELECT DISTINCT part FROM kinds) p, orders, range(1, 6) s(step)
), taken AS (
  SELECT e.part, e.filter_order, e.step, e.l, coalesce(sum(n), 0) AS removed,
         coalesce(sum(good), 0) AS good_lost, coalesce(sum(toxic), 0) AS toxic_lost
  FROM every e LEFT JOIN falls f
    ON e.part = f.part AND e.filter_order = f.filter_order AND e.step = f.step
  GROUP BY ALL
), wholes AS (SELECT part, sum(n) AS whole FROM kinds GROUP BY part)
SELECT t.part, t.filter_order, t.step::INT AS step,
       (whole - sum(removed) OVER (PARTITION BY t.part, t.filter_order ORDER BY t.step))::BIGINT
           AS kept,
       removed::BIGINT AS removed, (failing - removed)::BIGINT AS redundant,
       alone::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY t.part, t.l))::BIGINT AS shapley
FROM taken t JOIN fails f ON t.part = f.part AND t.l = f.l JOIN wholes w ON t.part = w.part
"""
