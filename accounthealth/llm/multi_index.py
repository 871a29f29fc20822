"""Approximate nearest neighbours by an inverted multi-index.

The two halves of the vectors are quantised separately, each by its own small
codebook, and a vector's cell is its pair of centroids. A query walks the
centroid pairs in order of their summed distance (here: falling inner product
of the halves) with a heap until the cells hold ``probe`` vectors; those are
reranked by the exact measure on the original vectors.

How far to walk depends on the data, so it is measured: ``TUNE_QUERIES`` queries
are compared with every vector, and ``probe`` is what the walk needs to meet
``RECALL`` of their true neighbours (``LEAST_PROBE`` at least). The more the
vectors lack structure, the larger a part of the index that is.

The codebooks are fitted to a bounded sample (``SAMPLE`` vectors by a hash of
their identifier); every vector is indexed. Cells are cut into units of at most
about ``UNIT`` vectors and units are dealt to tasks, so no cell grows a task; a
query is sent once to each task that holds one of its units. Of vectors that
are equal in every component only the ``k + 1`` smallest identifiers are
indexed, at most ``k`` rows of each and ``2 * k`` together: no other can be among
a query's k nearest, as ties go to the smaller identifier and a query leaves out
the rows of one identifier. More than ``TASK_QUERIES`` queries are split into parts, each with
tasks of its own.

Defined results: vectors that are null, zero, or hold null or non-finite
components take no part, nor do those whose length is not the commonest one
(the longer, on ties). Rows that repeat an identifier are separate
candidates, but never of their own identifier. Query rows that repeat an
identifier are separate queries, each with its own ranks. An empty table gives
no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accounthealth.llm.frames import quoted, staged

K = 20
LEAST_PROBE = 4000  # vectors a query looks at
TUNE_QUERIES, RECALL = 100, 0.97
SAMPLE = 20_000
MAX_CENTROIDS = 1024
ROUNDS = 12
UNIT = 2000
TASK_VECTORS = 5000
TASK_QUERIES = 20_000
BLOCK = 256  # queries scored at once


def valid_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, vector`` (doubles) of the rows that take part."""
    vector = F.col(quoted(vector_col)).cast("array<double>")
    limit = F.lit(float("inf"))
    good = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    some = F.exists("vector", lambda x: x != 0)
    rows = df.select(F.col(quoted(id_col)).alias("id"), vector.alias("vector")).filter(
        F.col("vector").isNotNull() & good & some)
    sizes = rows.groupBy(F.size("vector").alias("d")).count().orderBy(
        F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("vector") == (sizes["d"] if sizes else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def codebook(points: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Lloyd's rounds from randomly chosen points; empty centroids stay put."""
    rng = np.random.default_rng(seed)
    points = np.unique(points, axis=0)
    centres = points[rng.choice(len(points), min(size, len(points)), replace=False)]
    for _ in range(ROUNDS):
        near = nearest(points, centres)
        count = np.bincount(near, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, near, points)
        full = count > 0
        centres[full] = total[full] / count[full, None]
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.empty(len(points), np.int64)
    for lo in range(0, len(points), 4096):
        p = points[lo:lo + 4096]
        out[lo:lo + 4096] = ((centres ** 2).sum(axis=1) - 2 * p @ centres.T).argmin(axis=1)
    return out


def walk(first: np.ndarray, second: np.ndarray, held: np.ndarray, probe: int) -> list[int]:
    """Filled cells by falling ``first[i] + second[j]`` until they hold ``probe`` vectors.

    held[i * len(second) + j] counts the vectors of a cell.
    """
    a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    heap, out, found = [(-(first[a[0]] + second[b[0]]), 0, 0)], [], 0
    seen = {(0, 0)}
    while heap and found < probe:
        _, i, j = heapq.heappop(heap)
        cell = int(a[i]) * len(second) + int(b[j])
        if held[cell]:
            out.append(cell)
            found += int(held[cell])
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (-(first[a[x]] + second[b[y]]), x, y))
    return out


def _best(score: np.ndarray, names: np.ndarray, m: np.ndarray, query: np.ndarray,
          slack: float, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact scores of the k best of a row of quick scores (-inf: no candidate).

    Quick scores may differ by rounding between equal vectors; those within
    ``slack`` of the k-th are scored again, each row in the same way.
    """
    at = np.flatnonzero(score > -np.inf)
    if len(at) > k:
        at = at[score[at] >= np.partition(score[at], -k)[-k] - slack]
    exact = (m[at] * query).sum(axis=1)
    order = np.lexsort((names[at], -exact))[:k]
    return at[order], exact[order]


def _probe_for(indexed: DataFrame, tune: pa.Table, books: list[np.ndarray], held: np.ndarray,
               k: int) -> int:
    """How many vectors the walk must look at to meet RECALL of the k true
    neighbours of the ``id, vector`` queries in ``tune`` (a bounded sample)."""
    own = tune.column("id").to_numpy()
    q = _matrix(tune.column("vector").combine_chunks())

    def nearest_of_all(batches):
        top = [(np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in own]
        for batch in batches:
            m = _matrix(batch.column("vector"))
            names, cell = batch.column("id").to_numpy(), batch.column("cell").to_numpy()
            for n, score in enumerate(q @ m.T if len(m) else []):
                at = np.flatnonzero(names != own[n])
                if len(at) > k:
                    at = at[np.argpartition(-score[at], k - 1)[:k]]
                s, i, c = (np.concatenate(x) for x in zip(
                    top[n], (score[at], names[at], cell[at]), strict=True))
                best = np.lexsort((i, -s))[:k]
                top[n] = s[best], i[best], c[best]
        size = [len(t[0]) for t in top]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(own)), size)),
             *(pa.array(np.concatenate([t[x] for t in top])) for x in range(3))],
            names=["q", "score", "id", "cell"])

    order = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    found = indexed.mapInArrow(nearest_of_all, "q long, score double, id long, cell long")
    found = found.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k)
    found = found.select("q", "cell").toArrow()  # at most TUNE_QUERIES * k rows
    of, cell = (found.column(c).to_numpy() for c in ("q", "cell"))
    half, needed = books[0].shape[1], []
    for n in np.unique(of):
        near = ((books[0] @ q[n, :half])[:, None] + books[1] @ q[n, half:]).ravel()
        walked = np.argsort(-near, kind="stable")
        passed = np.empty(len(near), np.int64)
        passed[walked] = np.cumsum(held[walked])
        needed.append(passed[cell[of == n]])
    if not needed:
        return LEAST_PROBE
    return max(LEAST_PROBE, int(np.ceil(np.quantile(np.concatenate(needed), RECALL))))


def neighbours(df: DataFrame, queries: DataFrame, id_col: str = "vec_id",
               vector_col: str = "embedding", k: int = K, probe: int | None = None,
               seed: int = 1) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's nearest rows of ``df``.

    ``queries`` has the columns of ``df``; only its valid vectors are asked.
    ``probe`` None measures how far to walk.
    """
    spark = df.sparkSession
    rows = valid_vectors(df, id_col, vector_col)
    same = Window.partitionBy("vector").orderBy(F.col("id").asc_nulls_last())
    rows = rows.withColumn("nth", F.dense_rank().over(same)).filter(
        F.col("nth") <= k + 1)  # limited before the exchange, too
    for of, most in ((Window.partitionBy("vector", "id").orderBy("id"), k), (same, 2 * k)):
        rows = rows.withColumn("nth", F.row_number().over(of)).filter(F.col("nth") <= most)
    rows = rows.drop("nth")
    rows = staged(rows, "vectors")
    total = rows.count()
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").toArrow()
    points = _matrix(sample.column("vector").combine_chunks())
    if not len(points):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    half = points.shape[1] // 2
    size = int(min(MAX_CENTROIDS, max(4, total ** 0.5 / 4)))
    books = [codebook(points[:, :half], size, seed), codebook(points[:, half:], size, seed + 1)]
    width = len(books[1])
    shared = spark.sparkContext.broadcast(books)  # at most 2 * MAX_CENTROIDS half vectors

    def assign(batches):
        one, two = shared.value
        for batch in batches:
            m = _matrix(batch.column("vector"))
            cell = nearest(m[:, :half], one) * width + nearest(m[:, half:], two) if len(m) else \
                np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("vector"), pa.array(cell, pa.int64())],
                names=["id", "vector", "cell"])

    indexed = staged(rows.mapInArrow(assign, "id long, vector array<double>, cell long"), "index")
    counts = indexed.groupBy("cell").count().toArrow()  # at most MAX_CENTROIDS ** 2 cells
    held = np.zeros(len(books[0]) * width, np.int64)
    held[counts.column("cell").to_numpy()] = counts.column("count").to_numpy()
    cells = spark.sparkContext.broadcast(held)
    tasks = max(1, -(-total // TASK_VECTORS))

    def unit_task(cell, sub):  # which task holds a unit
        return (cell * 1_000_003 + sub * 7_919) % tasks

    asked = staged(valid_vectors(queries, id_col, vector_col).filter(
        F.size("vector") == points.shape[1]).withColumn(
        "key", F.monotonically_increasing_id()), "queries")  # a number for each query row
    parts = max(1, -(-asked.count() // TASK_QUERIES))
    if probe is None:
        tune = asked.orderBy(F.xxhash64("id"), "id").limit(TUNE_QUERIES).toArrow()
        probe = _probe_for(indexed, tune, books, held, k)

    sizes = indexed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / UNIT).alias("units"))
    units = indexed.join(sizes, "cell").withColumn(
        "sub", F.pmod(F.xxhash64("id"), F.col("units")))
    units = units.withColumn("task", unit_task(F.col("cell"), F.col("sub"))).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).select(
        "task", "part", "cell", "id", "vector")

    def route(batches):
        one, two = shared.value
        for batch in batches:
            out = {"task": [], "key": [], "id": [], "vector": [], "least": []}
            m = _matrix(batch.column("vector"))
            for key, q, vector in zip(batch.column("key").to_pylist(),
                                      batch.column("id").to_pylist(), m, strict=True):
                first, second = one @ vector[:half], two @ vector[half:]
                walked = walk(first, second, cells.value, probe)
                least = first[walked[-1] // width] + second[walked[-1] % width]
                for task in {unit_task(cell, sub) for cell in walked
                             for sub in range(-(-int(cells.value[cell]) // UNIT))}:
                    for name, x in zip(out, (task, key, q, vector, least), strict=True):
                        out[name].append(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["task"], pa.int64()), pa.array(out["key"], pa.int64()),
                 pa.array(out["id"], pa.int64()),
                 pa.array(out["vector"], pa.list_(pa.float64())),
                 pa.array(out["least"], pa.float64())], names=list(out))

    routed = asked.mapInArrow(
        route, "task long, key long, id long, vector array<double>, least double").withColumn(
        "part", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int"))

    def rerank(vectors: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        found = [(*(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0))]
        if len(vectors) and len(wanted):
            one, two = shared.value
            vectors = vectors.sort_values("cell", kind="stable")
            names, m = vectors["id"].to_numpy(), np.stack(vectors["vector"].to_numpy())
            cell, at = np.unique(vectors["cell"].to_numpy(), return_index=True)
            edges = np.r_[at, len(m)]
            longest = np.sqrt(np.square(m).sum(axis=1).max())
            for lo in range(0, len(wanted), BLOCK):
                block = wanted.iloc[lo:lo + BLOCK]
                key, own = block["key"].to_numpy(), block["id"].to_numpy()
                q = np.stack(block["vector"].to_numpy())
                slack = 1e-9 * longest * np.sqrt(np.square(q).sum(axis=1))
                # A query wants the cells that its walk passed: those not below its last.
                near = (one @ q[:, :half].T)[cell // width] + (two @ q[:, half:].T)[cell % width]
                wants = near >= block["least"].to_numpy() - slack
                score = np.full((len(q), len(m)), -np.inf)
                for c in range(len(cell)):
                    who = np.flatnonzero(wants[c])
                    score[who, edges[c]:edges[c + 1]] = q[who] @ m[edges[c]:edges[c + 1]].T
                for n in range(len(q)):
                    score[n, names == own[n]] = -np.inf
                    best, exact = _best(score[n], names, m, q[n], slack[n], k)
                    found.append((np.full(len(best), key[n]), np.full(len(best), own[n]),
                                  names[best], exact))
        return pd.DataFrame(dict(zip(
            ("key", "query_id", "vec_id", "score"), map(np.concatenate, zip(*found, strict=True)), strict=True)))

    some = units.groupBy("task", "part").cogroup(routed.groupBy("task", "part")).applyInPandas(
        rerank, "key long, query_id long, vec_id long, score double")
    order = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    return some.withColumn("rank", F.row_number().over(order)).filter(
        F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_multi_index(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return neighbours(vectors, vectors.filter("vec_id % 20 = 0"))
