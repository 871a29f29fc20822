"""Shard placement by a permutation-filled lookup table.

Every shard prefers the slots of a prime-sized table in an order of its own
(a start and a stride from its name's digest). The shards take turns: at its
turn a shard claims the first slot on its list that is still free. The full
table is broadcast and a document's shard is the owner of the slot that its
key's digest falls on, found in constant time; no shuffle, so hot keys, hot
sources and copies cannot skew the placement.

The table is a parameter-sized constant (at most ``MAX_SLOTS`` rows, whatever
the corpus), filled once by the driver; the placement of rows uses built-in
functions only.

Defined results: a null key is placed like the empty string; equal keys share
a shard; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accounthealth.llm.frames import packed, quoted

SHARDS = tuple(f"shard-{i:02d}" for i in range(16))
SLOTS = 1609  # a prime, about a hundred slots a shard
MAX_SLOTS = 65_537
DIGITS = 15  # hexadecimal digits of a digest that become a number


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:DIGITS], 16)


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def lookup_table(shards=SHARDS, slots: int = SLOTS) -> list[str]:
    """Owner of each slot. ``slots`` must be a prime of at least the number of
    shards, so that every stride walks the whole table."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct names, at least one")
    if not _is_prime(slots) or not len(shards) <= slots <= MAX_SLOTS:
        raise ValueError(f"slots must be a prime from {len(shards)} to {MAX_SLOTS}")
    at = [_number("start:" + s) % slots for s in shards]
    stride = [_number("stride:" + s) % (slots - 1) + 1 if slots > 2 else 1 for s in shards]
    owner: list[str | None] = [None] * slots
    free = slots
    while free:
        for k, name in enumerate(shards):
            if not free:
                break
            while owner[at[k]] is not None:
                at[k] = (at[k] + stride[k]) % slots
            owner[at[k]] = name
            free -= 1
    return owner


def table_frame(spark: SparkSession, shards=SHARDS, slots: int = SLOTS) -> DataFrame:
    """The lookup table as ``slot, shard`` rows, built from one literal."""
    names = F.array(*[F.lit(s) for s in shards])
    where = {s: str(i) for i, s in enumerate(shards)}
    order = F.lit(",".join(where[s] for s in lookup_table(shards, slots)))
    owners = F.split(order, ",")
    return (spark.range(1).select(F.posexplode(owners).alias("slot", "nth"))
            .select("slot", F.element_at(names, F.col("nth").cast("int") + 1).alias("shard")))


def place(df: DataFrame, key_col: str = "doc_id", shards=SHARDS, slots: int = SLOTS) -> DataFrame:
    """``key, slot, shard, row`` for every input row; ``row`` holds its other columns."""
    key = F.coalesce(F.col(quoted(key_col)).cast("string"), F.lit(""))
    slot = F.pmod(F.conv(F.substring(F.md5(key), 1, DIGITS), 16, 10).cast("long"),
                  F.lit(slots)).cast("int")
    rows = df.select(F.col(quoted(key_col)).alias("key"), slot.alias("slot"),
                     packed(df, key_col).alias("row"))
    return rows.join(F.broadcast(table_frame(df.sparkSession, shards, slots)), "slot").select(
        "key", "slot", "shard", "row")


def write_shards(df: DataFrame, path: str, key_col: str = "doc_id", **options) -> None:
    """Writes ``df`` under ``path``, one folder a shard. Each task writes its
    own file into every shard it meets, so a shard's size bounds nothing."""
    placed = place(df, key_col, **options)
    columns = [F.col("key").alias(c) if c == key_col else F.col("row").getField(c).alias(c)
               for c in df.columns if c != "shard"]
    placed.select(*columns, "shard").write.partitionBy("shard").parquet(path)


def op2_sharding(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    placed = place(docs.withColumn("n_bytes", F.octet_length(F.coalesce("text", F.lit(""))))
                   .drop("text"))
    return placed.select(F.col("key").alias("doc_id"), "slot", "shard",
                         F.col("row.n_bytes").cast("long").alias("n_bytes"))


# The oracle fills the table one claim at a time over a list of owners.
OP2_SQL = f"""
WITH RECURSIVE shards AS (
  SELECT i, printf('shard-%02d', i) AS name FROM range({len(SHARDS)}) t(i)
), lists AS (
  SELECT i, list(((s + j * d) % {SLOTS})::INTEGER ORDER BY j) AS wants
  FROM (SELECT i, CAST('0x' || substr(md5('start:' || name), 1, {DIGITS}) AS BIGINT) % {SLOTS} AS s,
               CAST('0x' || substr(md5('stride:' || name), 1, {DIGITS}) AS BIGINT) % ({SLOTS} - 1) + 1 AS d
        FROM shards), range({SLOTS}) r(j)
  GROUP BY i
), claims AS (
  SELECT 0 AS turn, CAST(NULL AS INTEGER) AS slot,
         [true for x in range({SLOTS})] AS free
  UNION ALL
  SELECT turn + 1, won, free[:won] || [false] || free[won + 2:]
  FROM (SELECT turn, free, [x for x in wants if free[x + 1]][1] AS won
        FROM claims JOIN lists ON lists.i = turn % {len(SHARDS)} WHERE turn < {SLOTS})
), owners AS (
  SELECT slot, printf('shard-%02d', (turn - 1) % {len(SHARDS)}) AS shard FROM claims WHERE turn > 0
)
SELECT doc_id, slot, shard, strlen(coalesce(text, ''))::BIGINT AS n_bytes
FROM documents JOIN owners
  ON slot = CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, {DIGITS}) AS BIGINT) % {SLOTS}
"""
