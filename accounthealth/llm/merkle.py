"""Merkle manifest of a table with nested-interval labels.

Every row is a leaf: the digest of its columns. Rows are trees by a group
column; inside a tree leaves are ranked by identifier, and a node carries the
interval ``[lo, hi)`` of leaf ranks it covers. ``FAN`` consecutive nodes of one
level become the digest of their digests (the last run may have fewer, even
one) until one node is left, the tree's top. The tops, ordered by group, are
the leaves of one more tree, whose top is the root.

1. Ranks. Leaves are range-partitioned by (tree, identifier, digest) and written;
   rows before each partition come from one count a (partition, tree).
2. Nodes. Levels go in bands of ``BAND``. A task takes the aligned leaves (or
   nodes of the band's lowest level) of one interval of ``FAN ** BAND``, builds
   the levels of the band and hands its top to the next band. So no task holds
   a tree, and there are as many rounds as bands.
3. Proofs, from the highest band down. In each band the nodes of a level join
   the nodes of the levels above whose interval contains theirs; a node's
   siblings are the nodes of the difference between the parent's interval and
   its own, left and right. What the band above found for the interval is
   appended, so a proof is never shuffled until it is whole.

A proof is two arrays, the digests left and right of the path, level by level
(an empty string where there is none); ``folded`` recomputes the root from any
leaf and a proof.

Defined results: a null is ``-`` in a leaf, an empty text ``0:``. A null group
is a tree of its own, before the others. Null identifiers come first in their
tree; rows of one identifier go by their digest, so that repeated rows are
leaves of their own in any order. A tree of one leaf has that leaf as its top.
An empty table has no rows. Columns that are not named take no part.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accounthealth.llm.frames import quoted, staged
from accounthealth.llm.ranking import running

FAN = 2
BAND = 8
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
FORGED_PARTS = 7  # tampering hits the identifiers whose checksum it divides


# ---- leaves

def leaf_part(value: Column) -> Column:
    """One value's share of a leaf: its byte count and text, or a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[leaf_part(v) for v in values]), 256)


def tree_key(group: Column) -> Column:
    """Never null; sorts like the group in UTF-8 bytes, null first."""
    return F.coalesce(F.concat(F.lit("g"), group.cast("string")), F.lit(""))


def leaves(df: DataFrame, columns: Sequence[str] = COLUMNS, group_col: str = "lang",
           id_col: str = "doc_id", forged: dict[str, Column] | None = None) -> DataFrame:
    """``tree, id, digest, forged``: ``forged`` is the digest of the row with the columns of
    that name replaced (the same digest without)."""
    own = [F.col(quoted(c)) for c in columns]
    other = [(forged or {}).get(c, F.col(quoted(c))) for c in columns]
    return df.select(
        tree_key(F.col(quoted(group_col))).alias("tree"), F.col(quoted(id_col)).alias("id"),
        leaf_digest(own).alias("digest"),
        (leaf_digest(other) if forged else F.lit(None).cast("string")).alias("forged"))


def ranked(rows: DataFrame) -> DataFrame:
    """The leaves with their interval: ``tree, size, level, lo, hi, id, digest, forged``."""
    found = running(rows, ["tree"], ["id", "digest"])
    return found.select("tree", F.col("whole").alias("size"), F.lit(0).alias("level"),
                        F.col("before").alias("lo"), (F.col("before") + 1).alias("hi"),
                        "id", "digest", "forged")


# ---- nodes

def _hex(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def build_band(table: pa.Table, base: int, fan: int, band: int) -> pa.Table:
    """All nodes of the levels ``base`` to ``base + band`` over the given nodes of level ``base``."""
    table = table.drop_columns("place").sort_by("lo")
    size = table.column("size")[0].as_py()
    lo = table.column("lo").to_numpy()
    hi = table.column("hi").to_numpy()
    digest = table.column("digest").to_pylist()
    made, level = [], base
    while level < base + band and size > fan ** level:
        level += 1
        parent = lo // fan ** level
        first = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])
        edges = np.r_[first, len(lo)]
        digest = [_hex("".join(digest[a:b])) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        lo, hi = lo[first], hi[edges[1:] - 1]
        made.append((level, lo, hi, digest))
    if not made:
        return table
    n = sum(len(x[1]) for x in made)
    nodes = pa.table({
        "tree": pa.array([table.column("tree")[0].as_py()] * n, pa.string()),
        "size": pa.array(np.full(n, size), pa.int64()),
        "level": pa.array(np.repeat([x[0] for x in made], [len(x[1]) for x in made]), pa.int32()),
        "lo": pa.array(np.concatenate([x[1] for x in made]), pa.int64()),
        "hi": pa.array(np.concatenate([x[2] for x in made]), pa.int64()),
        "id": pa.nulls(n, table.schema.field("id").type),
        "digest": pa.array([d for x in made for d in x[3]], pa.string()),
        "forged": pa.nulls(n, pa.string())})
    return pa.concat_tables([table.select(nodes.column_names), nodes]).select(table.column_names)


def _builder(base: int, fan: int, band: int):
    return lambda table: build_band(table, base, fan, band)


def _prover(base: int):
    return lambda table, above: band_proofs(table, above, base)


def node_bands(entry: DataFrame, fan: int = FAN, band: int = BAND) -> list[DataFrame]:
    """The nodes of every band, lowest first. A node on the border of two bands is in both:
    as the top of the lower, as the bottom of the upper."""
    kinds = ", ".join(f"{c} {t}" for c, t in entry.dtypes)
    bands, base = [], 0
    while True:
        place = F.expr(f"lo div {fan ** (base + band)}")
        nodes = staged(entry.withColumn("place", place).groupBy("tree", "place")
                       .applyInArrow(_builder(base, fan, band), kinds), "nodes")
        bands.append(nodes)
        base += band
        entry = nodes.filter((F.col("level") == base) & (F.col("size") > fan ** base))
        if entry.isEmpty():
            return bands


# ---- proofs

def containing(lo: np.ndarray, hi: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The node of one level (sorted, apart) whose interval contains each rank."""
    found = np.searchsorted(lo, at, side="right") - 1
    if (found < 0).any() or (hi[found] <= at).any():
        raise ValueError("a rank lies in no interval of the level")
    return found


def siblings(lo, hi, digest, above_lo, above_hi) -> tuple[list[str], list[str]]:
    """For each node of a level the digests left and right of it inside its parent's
    interval: those of the difference of the two intervals."""
    parent = containing(above_lo, above_hi, lo)
    own = np.arange(len(lo))
    first = np.searchsorted(lo, above_lo[parent], side="left")
    stop = np.searchsorted(lo, above_hi[parent], side="left")
    left = ["".join(digest[a:k]) for a, k in zip(first, own, strict=True)]
    right = ["".join(digest[k + 1:b]) for k, b in zip(own, stop, strict=True)]
    return left, right


def band_proofs(table: pa.Table, above: pa.Table, base: int) -> pa.Table:
    """The proofs of the nodes of level ``base``; ``above`` has the one row of what the
    bands above found for this interval."""
    table = table.sort_by([("level", "ascending"), ("lo", "ascending")])
    level = table.column("level").to_numpy()
    lo, hi = table.column("lo").to_numpy(), table.column("hi").to_numpy()
    digest = table.column("digest").to_pylist()
    edges = np.searchsorted(level, np.arange(base, int(level[-1]) + 2))
    rows = int(edges[1])
    steps = len(edges) - 2
    left = np.empty((rows, steps), object)
    right = np.empty((rows, steps), object)
    for k in range(steps):
        a, b, c = edges[k:k + 3]
        ls, rs = siblings(lo[a:b], hi[a:b], digest[a:b], lo[b:c], hi[b:c])
        at = containing(lo[a:b], hi[a:b], lo[:rows])
        left[:, k] = np.array(ls, object)[at]
        right[:, k] = np.array(rs, object)[at]
    up = above.to_pylist()[0]
    ends = pa.array(np.arange(rows + 1) * (steps + len(up["left"])), pa.int32())

    def joined(own, more):
        whole = np.empty((rows, steps + len(more)), object)
        whole[:, :steps] = own
        whole[:, steps:] = np.array(more + [None], object)[:-1]
        return pa.ListArray.from_arrays(ends, pa.array(whole.ravel().tolist(), pa.string()))

    bottom = table.slice(0, rows)
    top = up["top"] or digest[-1]
    return pa.table({
        "tree": bottom.column("tree"), "lo": bottom.column("lo"), "id": bottom.column("id"),
        "digest": bottom.column("digest"), "forged": bottom.column("forged"),
        "left": joined(left, up["left"]), "right": joined(right, up["right"]),
        "top": pa.array([top] * rows, pa.string()),
        "root": pa.array([up["root"]] * rows, pa.string())})


def proofs(bands: list[DataFrame], above: DataFrame, fan: int = FAN,
           band: int = BAND) -> DataFrame:
    """``tree, lo, id, digest, forged, left, right, top, root`` of every leaf.

    ``above``: ``tree, left, right, root``, what follows over the trees' tops."""
    kinds = dict(bands[0].dtypes)
    schema = (f"tree string, lo long, id {kinds['id']}, digest string, forged string, "
              "left array<string>, right array<string>, top string, root string")
    found = None
    for nth in reversed(range(len(bands))):
        base, width = nth * band, fan ** ((nth + 1) * band)
        # Trees that end in this band take their tops' proofs, the others the next band's.
        ended = bands[nth].filter("level = " + str(base)).select("tree", "size").distinct()
        ended = ended.filter(F.col("size") <= width).join(above, "tree").select(
            "tree", F.lit(0).cast("long").alias("place"), "left", "right",
            F.lit(None).cast("string").alias("top"), "root")
        up = ended if found is None else ended.unionByName(found.select(
            "tree", F.expr(f"lo div {width}").alias("place"), "left", "right", "top", "root"))
        nodes = bands[nth].withColumn("place", F.expr(f"lo div {width}"))

        up = up.withColumnsRenamed({"tree": "up_tree", "place": "up_place"}).select(
            *[F.col(c).alias(c) for c in ("up_tree", "up_place", "left", "right", "top", "root")])
        found = nodes.groupBy("tree", "place").cogroup(
            up.groupBy("up_tree", "up_place")).applyInArrow(_prover(base), schema)
        if nth:
            found = staged(found, "proofs")
    return found


def manifest(rows: DataFrame, fan: int = FAN, band: int = BAND) -> tuple[DataFrame, list, list]:
    """The proofs of all ``leaves`` rows up to the root, and the node bands of the trees and of
    the tree over their tops."""
    trees = node_bands(ranked(rows), fan, band)
    every = trees[0]
    for more in trees[1:]:
        every = every.unionByName(more)
    tops = every.filter((F.col("lo") == 0) & (F.col("hi") == F.col("size"))).groupBy("tree").agg(
        F.max(F.struct("level", "digest")).alias("top"))
    crown = node_bands(ranked(tops.select(
        F.lit("").alias("tree"), F.col("tree").alias("id"), F.col("top.digest").alias("digest"),
        F.lit(None).cast("string").alias("forged"))), fan, band)
    none = crown[0].select("tree").distinct().select(
        "tree", F.array().cast("array<string>").alias("left"),
        F.array().cast("array<string>").alias("right"), F.lit(None).cast("string").alias("root"))
    above = staged(proofs(crown, none, fan, band), "proofs").select(
        F.col("id").alias("tree"), "left", "right", F.col("top").alias("root"))
    return proofs(trees, above, fan, band), trees, crown


def folded(leaf: Column, left: Column, right: Column) -> Column:
    """The digest that a leaf and its siblings lead to."""
    return F.aggregate(F.arrays_zip(left.alias("left"), right.alias("right")), leaf,
                       lambda now, s: F.sha2(F.concat(s["left"], now, s["right"]), 256))


def proof_digest(left: Column, right: Column) -> Column:
    """One digest for all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(
        F.arrays_zip(left.alias("left"), right.alias("right")),
        lambda s: F.concat(s["left"], s["right"])), ""), 256)


def op11_merkle(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    hit = F.crc32(F.col("doc_id").cast("string")) % FORGED_PARTS == 0
    count = F.col("n_chars").cast("decimal(20,0)")
    rows = leaves(docs, forged={"n_chars": F.when(hit, count + 1).otherwise(count)})
    found, _, _ = manifest(rows)
    left, right = F.col("left"), F.col("right")
    out = found.select("id", "digest", "top", "root", proof_digest(left, right).alias("proof"),
                       folded(F.col("forged"), left, right).alias("folded"))
    return out.select(
        F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), F.col("top").alias("subroot"),
        "root", F.col("proof").alias("proof_sha256"), F.col("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"))


# The oracle has no intervals: nodes are numbered, a sibling's number differs in the last bit.
OP11_SQL = r"""
WITH RECURSIVE sums AS (
  SELECT *, xor(list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
          string_split(CAST(doc_id AS VARCHAR), ''),
          lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x)
                          WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384)
                          ELSE crc // 2 END), 4294967295) AS crc
  FROM documents
), parts AS (
  SELECT doc_id, lang,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
         || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS chars,
         CASE WHEN doc_id IS NOT NULL AND crc % 7 = 0
              THEN coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-')
              ELSE coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') END AS other,
         coalesce(strlen(text) || ':' || text, '-') AS tail
  FROM sums
), hashed AS (
  SELECT doc_id, lang, sha256(head || chars || tail) AS leaf,
         sha256(head || other || tail) AS forged
  FROM parts
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank
  FROM hashed
), up AS (
  SELECT lang, 0 AS level, rank AS pos, leaf AS h FROM leaves
  UNION ALL
  SELECT lang, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS nodes FROM up)
  WHERE nodes > 1 GROUP BY lang, level, pos // 2
), tops AS (
  SELECT *, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS rank
  FROM (SELECT lang, h AS subroot, level AS height FROM up
        QUALIFY level = max(level) OVER (PARTITION BY lang))
), crown AS (
  SELECT 0 AS level, rank AS pos, subroot AS h FROM tops
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS nodes FROM crown)
  WHERE nodes > 1 GROUP BY level, pos // 2
), root AS (SELECT h AS root, level AS height FROM crown ORDER BY level DESC LIMIT 1),
paths AS (
  SELECT l.lang, l.rank, s.level, l.rank >> s.level AS own, 0 AS part
  FROM leaves l JOIN tops t ON l.lang IS NOT DISTINCT FROM t.lang,
       range(0, 64) s(level) WHERE s.level < t.height
), steps AS (
  SELECT p.lang, p.rank, 0 AS part, p.level,
         CASE WHEN u.h IS NULL THEN 'N' WHEN p.own % 2 = 1 THEN 'L' ELSE 'R' END
         || coalesce(u.h, '') AS step
  FROM paths p LEFT JOIN up u ON p.lang IS NOT DISTINCT FROM u.lang AND p.level = u.level
       AND u.pos = xor(p.own, 1)
), crown_steps AS (
  SELECT t.lang, s.level, CASE WHEN u.h IS NULL THEN 'N' WHEN (t.rank >> s.level) % 2 = 1 THEN 'L'
                               ELSE 'R' END || coalesce(u.h, '') AS step
  FROM tops t CROSS JOIN (SELECT level FROM range(0, 64) r(level), root WHERE level < height) s
  LEFT JOIN crown u ON u.level = s.level AND u.pos = xor(t.rank >> s.level, 1)
), tree_lists AS (
  SELECT lang, rank, list(step ORDER BY level) AS steps FROM steps GROUP BY lang, rank
), crown_lists AS (
  SELECT lang, list(step ORDER BY level) AS steps FROM crown_steps GROUP BY lang
), whole AS (
  SELECT l.*, t.subroot, r.root,
         list_concat(coalesce(x.steps, []), coalesce(c.steps, [])) AS steps
  FROM leaves l JOIN tops t ON l.lang IS NOT DISTINCT FROM t.lang CROSS JOIN root r
  LEFT JOIN tree_lists x ON l.lang IS NOT DISTINCT FROM x.lang AND l.rank = x.rank
  LEFT JOIN crown_lists c ON l.lang IS NOT DISTINCT FROM c.lang
), folds AS (
  SELECT *, list_reduce(list_prepend(forged, steps), lambda now, s:
           CASE s[1] WHEN 'L' THEN sha256(s[2:] || now) WHEN 'R' THEN sha256(now || s[2:])
                     ELSE sha256(now) END) AS folded
  FROM whole
)
SELECT doc_id, leaf, subroot, root,
       sha256(array_to_string(list_transform(steps, lambda s: s[2:]), '')) AS proof_sha256,
       folded AS folded_root, folded = root AS verified
FROM folds
"""
