"""N-gram Jaccard join by T-occurrence search (skip-and-divide lists).

Every text becomes its set of distinct word shingles. Equal sets are one class.
Two classes link when ``100 * overlap >= percent * union``, so a set of n
shingles needs ``ceil(percent * n / 100)`` common ones with any partner: at
least that many of its inverted lists must hold the partner (T-occurrence).

1. Long lists. Shingles held by many texts are counted over all texts; at most
   ``MAX_HOT`` of the longest lists get a mark in a bitmap of fixed size. The
   mark only orders the lists (long ones last), it never decides a result.
2. Short lists. With T - 1 of its longest lists put aside, a set must meet any
   partner in one of the rest. Those postings are dealt by shingle. Lists
   without the mark give pairs with their number of common short lists, and a
   pair stays if that number plus the lists put aside can reach the overlap.
   Marked lists (they count only for sets that are nearly all shared text) and
   any other list of more than ``LONG_LIST`` sets are not expanded to pairs:
   neighbours by set size are chained, which joins at least the same sets.
3. The pairs and chains join sets into blocks (``components``), which are cut
   into shards of bounded shingle volume. Each pair of shards of a block is one
   task's T-occurrence search: short lists are merged (by a heap, or by a
   sort of the runs when they are long), the lists put aside are counted (the
   longest by binary search), and every pair that reaches the overlap links.
   Tasks return a number of links for each class and only those links that span
   its components, so their rows grow with the classes, not with the pairs;
   ``class_links`` returns all pairs of classes.

The links of a document are the other rows of its class and all rows of the
classes that its class links with.

Values of words, shingles and classes are 64-bit; the sets of a class are
compared by two such sums and their size. Identifiers may repeat.

Defined results: null, empty or blank texts have no shingles and link with
nothing; a text of fewer words than a shingle is one shingle of all its words.
Rows without an identifier link like others; a component has the smallest
identifier that is not null, and null if all are.
"""

from __future__ import annotations

import heapq
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accounthealth.llm.components import components
from accounthealth.llm.frames import packed, quoted, staged
from accounthealth.llm.textbytes import Chunk, chunks, mixed, run_values, word_values

SIZE, PERCENT = 5, 75
LONG_LIST = 32  # texts; longer lists get the mark
MAX_HOT = 1 << 20
MARK_BITS = 22
SHARD_SHINGLES = 2_000_000
SHARD_SETS = 4000  # when all pairs are returned
PARCEL_SHINGLES = 1 << 19  # shingles that a task deals at once (a longer text alone)
_SECOND = np.uint64(0xD6E8FEB86659FD93)


# ---- sets

def shingle_sets(chunk: Chunk, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle values (uint64) of each text of the chunk."""
    words = word_values(chunk, fold=True)
    runs = run_values(words, size)
    out = []
    for lo, hi in zip(chunk.first[:-1], chunk.first[1:], strict=True):
        if hi - lo >= size:
            values = runs[lo:hi - size + 1]
        else:
            values = run_values(words[lo:hi], hi - lo) + np.uint64(hi - lo) if hi > lo else words[:0]
        values = np.sort(values)
        out.append(values[np.r_[True, values[1:] != values[:-1]]] if len(values) else values)
    return out


def class_values(values: np.ndarray) -> tuple[int, int]:
    """Two 64-bit values of a set, as signed integers."""
    a = mixed(values).sum(dtype=np.uint64) + np.uint64(len(values))
    b = mixed(values ^ _SECOND).sum(dtype=np.uint64)
    return tuple(int(x) for x in mixed(np.array([a, b])).view(np.int64))


def _needed(n, percent):
    return -(-percent * n // 100)


def _overlap(n, m, percent):
    """The least overlap of linked sets of n and m shingles."""
    return -(-percent * (n + m) // (100 + percent))


def _text_sets(batches, size):
    """(batch, index in it, set) for each text; batches have id and text columns."""
    for batch in batches:
        for chunk in chunks(batch.column("text")):
            for k, values in enumerate(shingle_sets(chunk, size)):
                yield batch, chunk.row + k, values


def _parcels(batch, size):
    """Lists of (index in the batch, set) of bounded shingle volume."""
    parcel, volume = [], 0
    for _, k, values in _text_sets([batch], size):
        if len(values):
            parcel.append((k, values))
            volume += len(values)
        if volume >= PARCEL_SHINGLES:
            yield parcel
            parcel, volume = [], 0
    if parcel:
        yield parcel


def set_classes(df: DataFrame, size: int = SIZE) -> DataFrame:
    """``id, row, n, k1, k2`` for the ``id, text, row`` of every input row."""
    def run(batches):
        for batch in batches:
            n, k1, k2 = [], [], []
            for _, _, values in _text_sets([batch], size):
                a, b = class_values(values)
                n.append(len(values)), k1.append(a), k2.append(b)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, pa.int32()), pa.array(k1, pa.int64()),
                 pa.array(k2, pa.int64()), batch.column("row")],
                names=["id", "n", "k1", "k2", "row"])

    kinds = dict(df.dtypes)
    return df.select("id", "text", "row").mapInArrow(
        run, f"id {kinds['id']}, n int, k1 long, k2 long, row {kinds['row']}")


# ---- long lists

def _dealt(owner: np.ndarray, bits: int, *columns: np.ndarray):
    """(bucket, blob) rows: the columns' bytes, dealt by the owner's top bits."""
    bucket = (owner >> np.uint64(64 - bits)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange((1 << bits) + 1))
    columns = [c[order] for c in columns]
    full = np.flatnonzero(np.diff(edges))
    return full, [b"".join(c[edges[k]:edges[k + 1]].tobytes() for c in columns) for k in full]


def _below(owner: np.ndarray, bits: int) -> np.ndarray:
    """The 32 bits below the bucket's."""
    return (owner >> np.uint64(32 - bits)).astype(np.uint32)


def _bucket_bits(df: DataFrame) -> int:
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(20, max(8, (4 * parts - 1).bit_length()))


def mark_of(values: np.ndarray, bits: int) -> np.ndarray:
    """Place of a shingle in the bitmap: a function of its bucket and 32 bits."""
    key = (values >> np.uint64(32 - bits))
    return (mixed(key) >> np.uint64(64 - MARK_BITS)).astype(np.int64)


def long_list_marks(texts: DataFrame, bits: int, size: int) -> np.ndarray:
    """Bitmap of the shingles that more than LONG_LIST texts hold."""
    def count(batches):
        for batch in batches:
            for parcel in _parcels(batch, size):
                every = np.concatenate([values for _, values in parcel])
                full, blobs = _dealt(every, bits, _below(every, bits))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full, pa.int64()), pa.array(blobs, pa.binary())],
                    names=["bucket", "blob"])

    def long_ones(bucket: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        low = np.sort(np.concatenate([np.frombuffer(b, np.uint32) for b in frame["blob"]]))
        at = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
        held = np.diff(np.r_[at, len(low)])
        keep = held > LONG_LIST
        key = (np.int64(bucket[0]) << 32) | low[at[keep]].astype(np.int64)
        return pd.DataFrame({"key": key, "held": held[keep].astype(np.int64)})

    dealt = texts.mapInArrow(count, "bucket long, blob binary")
    found = dealt.groupBy("bucket").applyInPandas(long_ones, "key long, held long")
    rows = found.orderBy(F.desc("held"), "key").limit(MAX_HOT).select("key").toArrow()
    marks = np.zeros(1 << MARK_BITS, bool)
    keys = rows.column("key").to_numpy().astype(np.uint64)
    marks[mark_of(keys << np.uint64(32 - bits), bits)] = True
    return marks


# ---- short lists

_POSTING = (("low", np.uint32), ("key", np.int64), ("n", np.uint32), ("aside", np.uint16))


def postings(texts: DataFrame, marks, bits: int, size: int, percent: int) -> DataFrame:
    """``bucket, blob``: the short-list entries of every set, dealt by shingle."""
    def run(batches):
        for batch in batches:
            for parcel in _parcels(batch, size):
                parts = []
                for _, values in parcel:
                    n = len(values)
                    long = marks.value[mark_of(values, bits)]
                    order = np.concatenate([values[~long], values[long]])
                    prefix = order[:n - int(_needed(n, percent)) + 1]
                    aside = max(0, len(prefix) - int((~long).sum()))
                    parts.append((prefix, class_values(values)[0], n, min(aside, 65535)))
                lens = [len(p[0]) for p in parts]
                every = np.concatenate([p[0] for p in parts])
                full, blobs = _dealt(
                    every, bits, _below(every, bits),
                    np.repeat(np.array([p[1] for p in parts], np.int64), lens),
                    np.repeat(np.array([p[2] for p in parts], np.uint32), lens),
                    np.repeat(np.array([p[3] for p in parts], np.uint16), lens))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full, pa.int64()), pa.array(blobs, pa.binary())],
                    names=["bucket", "blob"])

    return texts.mapInArrow(run, "bucket long, blob binary")


def _read_postings(blobs) -> dict[str, np.ndarray]:
    width = sum(np.dtype(t).itemsize for _, t in _POSTING)
    out = {name: [] for name, _ in _POSTING}
    for blob in blobs:
        n, at = len(blob) // width, 0
        for name, kind in _POSTING:
            out[name].append(np.frombuffer(blob, kind, n, at))
            at += n * np.dtype(kind).itemsize
    return {name: np.concatenate(v) for name, v in out.items()}


def _pairs_of_bucket(bucket: int, blobs, marks: np.ndarray, bits: int, percent: int) -> pd.DataFrame:
    """Pairs of a bucket's lists with the number of lists they share there."""
    p = _read_postings(blobs)
    order = np.lexsort((p["key"], p["n"], p["low"]))
    p = {k: v[order] for k, v in p.items()}
    new = np.r_[True, (p["low"][1:] != p["low"][:-1]) | (p["key"][1:] != p["key"][:-1])]
    p = {k: v[new] for k, v in p.items()}  # a class counts once in a list
    at = np.flatnonzero(np.r_[True, p["low"][1:] != p["low"][:-1]])
    held = np.diff(np.r_[at, len(p["low"])])
    at, held = at[held > 1], held[held > 1]
    whole = (np.uint64(bucket) << np.uint64(32)) | p["low"][at].astype(np.uint64)
    # Lists too long to expand are chained, whether or not there was a mark left for them.
    long = marks[mark_of(whole << np.uint64(32 - bits), bits)] | (held > LONG_LIST)
    n = p["n"].astype(np.int64)
    aside = np.where(p["aside"] == 65535, 1 << 40, p["aside"].astype(np.int64))
    left, right, shared = [], [], []

    def fits(i, j):  # j is the larger set
        return 100 * n[i] >= percent * n[j]

    for start, size in zip(at[long], held[long], strict=True):
        i = np.arange(start, start + size - 1)
        i = i[fits(i, i + 1)]
        left.append(i), right.append(i + 1), shared.append(np.full(len(i), 1 << 40))
    for size in np.unique(held[~long]):
        starts = at[~long][held[~long] == size]
        step = max(1, 1_000_000 // (size * size))
        a, b = np.triu_indices(size, 1)
        for lo in range(0, len(starts), step):
            i = (starts[lo:lo + step, None] + a).ravel()
            j = (starts[lo:lo + step, None] + b).ravel()
            ok = fits(i, j)
            left.append(i[ok]), right.append(j[ok]), shared.append(np.ones(ok.sum(), np.int64))
    if not left:
        return pd.DataFrame({"a": [], "b": [], "shared": [], "least": []}, dtype="int64")
    i, j, shared = map(np.concatenate, (left, right, shared))
    # Needed in short lists: what the lists put aside cannot give.
    rest = np.maximum(_needed(n[i], percent), _needed(n[j], percent)) - 1
    least = _overlap(n[i], n[j], percent) - rest - np.minimum(aside[i], aside[j])
    a, b = np.minimum(p["key"][i], p["key"][j]), np.maximum(p["key"][i], p["key"][j])
    frame = pd.DataFrame({"a": a, "b": b, "shared": shared, "least": least})
    return frame.groupby(["a", "b"], as_index=False).agg({"shared": "sum", "least": "min"})


def candidate_edges(dealt: DataFrame, marks, bits: int, percent: int) -> DataFrame:
    """``a, b``: class pairs that may link, and the chains of the long lists."""
    def pairs(bucket: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return _pairs_of_bucket(int(bucket[0]), frame["blob"], marks.value, bits, percent)

    found = dealt.groupBy("bucket").applyInPandas(
        pairs, "a long, b long, shared long, least long")
    return (found.groupBy("a", "b").agg(F.sum("shared").alias("shared"),
                                        F.min("least").alias("least"))
            .filter("shared >= least and a <> b").select("a", "b"))


# ---- search

def partners(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int):
    """``q, linked`` for the sets of ``left``: all its links among those of ``right``.

    T-occurrence search: each set of ``left`` is a query against the inverted
    lists of the sets of ``right``. Two sets that are both in ``left`` and in
    ``right`` are given once, with the earlier as the query.
    """
    n = np.array([len(s) for s in sets], dtype=np.int64)
    indexed = np.flatnonzero(right)
    token = np.concatenate([sets[k] for k in indexed]) if len(indexed) else np.zeros(0, np.uint64)
    holder = np.repeat(indexed, n[indexed])
    order = np.argsort(token, kind="stable")  # holders stay in order inside a list
    token, holder = token[order], holder[order]
    at = np.flatnonzero(np.r_[True, token[1:] != token[:-1]]) if len(token) else np.zeros(0, np.int64)
    names, edges = token[at], np.r_[at, len(token)]
    spot = np.full(len(sets), -1)
    for q in np.flatnonzero(left):
        if not len(names):
            break
        where = np.minimum(np.searchsorted(names, sets[q]), len(names) - 1)
        where = where[names[where] == sets[q]]
        size = edges[where + 1] - edges[where]
        where = where[np.argsort(size, kind="stable")]
        aside = min(int(_needed(n[q], percent)) - 1, len(where))
        short, long = where[:len(where) - aside], where[len(where) - aside:]
        runs = [holder[edges[w]:edges[w + 1]] for w in short if edges[w + 1] - edges[w] > 1
                or holder[edges[w]] != q]
        total = sum(map(len, runs))
        if not total:
            continue
        if total <= 2000:
            met = [(d, sum(1 for _ in same)) for d, same in
                   groupby(heapq.merge(*[r.tolist() for r in runs]))]
            cand, count = (np.array(x, dtype=np.int64) for x in zip(*met, strict=True))
        else:
            cand, count = np.unique(np.concatenate(runs), return_counts=True)
        fit = (cand > q) if right[q] else (cand != q)
        fit |= ~left[cand]
        fit &= 100 * np.minimum(n[cand], n[q]) >= percent * np.maximum(n[cand], n[q])
        need = _overlap(n[cand], n[q], percent)
        fit &= count + len(long) >= need
        cand, count, need = cand[fit], count[fit], need[fit]
        # Lists not much longer than the candidates are counted whole.
        whole = int(np.searchsorted(edges[long + 1] - edges[long], 16 * len(cand), "right"))
        if len(cand) and whole:
            spot[cand] = np.arange(len(cand))
            place = spot[np.concatenate([holder[edges[w]:edges[w + 1]] for w in long[:whole]])]
            spot[cand] = -1
            count = count + np.bincount(place[place >= 0], minlength=len(cand))
        long = long[whole:]
        alive = count + len(long) >= need
        cand, count, need = cand[alive], count[alive], need[alive]
        for done, w in enumerate(long):
            if not len(cand):
                break
            entries = holder[edges[w]:edges[w + 1]]
            place = np.searchsorted(entries, cand)
            place[place == len(entries)] = 0
            count = count + (entries[place] == cand)
            alive = count + (len(long) - done - 1) >= need
            cand, count, need = cand[alive], count[alive], need[alive]
        if len(cand):
            yield int(q), cand


def search(keys: list[int], sets: list[np.ndarray], left: np.ndarray, right: np.ndarray,
           percent: int) -> list[tuple[int, int]]:
    """All links between sets of ``left`` and of ``right``, each once."""
    return [(keys[q], keys[c]) for q, found in partners(sets, left, right, percent)
            for c in found.tolist()]


def counted_links(keys: np.ndarray, sets: list[np.ndarray], weight: np.ndarray, left: np.ndarray,
                  right: np.ndarray, percent: int) -> pd.DataFrame:
    """``a, b, links``: links that span the components of sets (``links`` 0), and
    for each set with links the weight of its partners (``b`` is ``a``)."""
    parent, held, span = list(range(len(sets))), np.zeros(len(sets), np.int64), []

    def root(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for q, found in partners(sets, left, right, percent):
        held[q] += weight[found].sum()
        held[found] += weight[q]
        for c in found.tolist():
            a, b = root(q), root(c)
            if a != b:
                parent[max(a, b)] = min(a, b)
                span.append((q, c))
    one, two = np.array(span, np.int64).reshape(-1, 2).T
    some = np.flatnonzero(held)
    return pd.DataFrame({"a": keys[np.r_[one, some]], "b": keys[np.r_[two, some]],
                         "links": np.r_[np.zeros(len(one), np.int64), held[some]]})


def links_of_blocks(members: DataFrame, sets: DataFrame, percent: int,
                    pairs: bool = False) -> DataFrame:
    """``a, b, links`` of the classes, as ``counted_links`` has them; or all ``pairs`` ``a, b``.

    members: ``id, k1, n, size, block``; sets: ``id, k1, values``."""
    most = F.sum("n") / SHARD_SHINGLES
    if pairs:  # a task's rows grow with the square of its sets
        most = F.greatest(most, F.count(F.lit(1)) / SHARD_SETS)
    volume = members.groupBy("block").agg(F.ceil(most).cast("int").alias("shards"))
    # Blocks of one shard share tasks: other blocks' sets in the lists change nothing.
    bins = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4
    placed = members.join(volume, "block").withColumn(
        "shard", F.when(F.col("shards") > 1, F.pmod(F.xxhash64("k1"), F.col("shards")))
        .otherwise(0).cast("int"))
    other = F.explode(F.when(F.col("shards") > 1, F.sequence(F.lit(0), F.col("shards") - 1))
                      .otherwise(F.array(F.lit(0))))
    tasks = placed.withColumn("other", other).select(
        "id", "k1", "size",
        F.when(F.col("shards") > 1, F.col("block"))
        .otherwise(F.pmod(F.xxhash64("block"), F.lit(bins))).alias("place"),
        F.least("shard", "other").alias("i"), F.greatest("shard", "other").alias("j"), "shard",
        (F.col("shards") > 1).alias("cut"))
    work = tasks.join(sets, ["id", "k1"])

    def find(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates("k1").sort_values("k1")
        values = [np.frombuffer(v, np.uint64) for v in frame["values"]]
        keys, shard = frame["k1"].to_numpy(), frame["shard"].to_numpy()
        left, right = shard == key[2], shard == key[3]
        if not pairs:
            return counted_links(keys, values, frame["size"].to_numpy(), left, right, percent)
        found = [(np.full(len(c), keys[q]), keys[c])
                 for q, c in partners(values, left, right, percent)]
        a, b = map(np.concatenate, zip(*found, strict=True)) if found else (keys[:0], keys[:0])
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return work.groupBy("place", "cut", "i", "j").applyInPandas(
        find, "a long, b long" + (", links long" if not pairs else ""))


def _id_marks(ids: DataFrame) -> np.ndarray:
    """Bitmap of fixed size over the identifiers' hashes (a prefilter only)."""
    place = F.shiftrightunsigned(F.xxhash64("id"), 64 - MARK_BITS).cast("int")
    rows = ids.select(place.alias("p")).distinct().toArrow()
    marks = np.zeros(1 << MARK_BITS, bool)
    marks[rows.column("p").to_numpy()] = True
    return marks


def _searchable(rows: DataFrame, size: int, percent: int) -> tuple[DataFrame, ...]:
    """The classes of every row, the distinct classes, and the members and sets of the blocks."""
    spark = rows.sparkSession
    key = F.xxhash64("id", "text")  # finds a class's set again; never null
    found = staged(set_classes(rows.withColumn("row", key), size), "classes")
    classes = found.filter("n > 0").groupBy("k1", "k2", "n").agg(
        F.min("id").alias("rep"), F.min("row").alias("key"), F.count(F.lit(1)).alias("size"))
    found = found.drop("row")
    bits = _bucket_bits(rows)
    texts = rows.select(key.alias("id"), "text")
    marks = spark.sparkContext.broadcast(long_list_marks(texts, bits, size))
    edges = candidate_edges(postings(texts, marks, bits, size, percent), marks, bits, percent)
    blocks = components(edges)
    members = staged(blocks.join(classes, blocks.node == classes.k1)
                     .select(F.col("key").alias("id"), "k1", "n", "size",
                             F.col("component").alias("block")), "members")
    wanted = spark.sparkContext.broadcast(_id_marks(members))

    def sets_of(batches):
        for batch in batches:
            take = wanted.value[batch.column("place").to_numpy()]
            batch = batch.filter(pa.array(take))
            for parcel in _parcels(batch, size):
                ids = batch.column("id").take(pa.array([k for k, _ in parcel]))
                k1 = [class_values(values)[0] for _, values in parcel]
                blobs = [values.tobytes() for _, values in parcel]
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(k1, pa.int64()), pa.array(blobs, pa.binary())],
                    names=["id", "k1", "values"])

    place = F.shiftrightunsigned(F.xxhash64("id"), 64 - MARK_BITS).cast("int")
    sets = texts.withColumn("place", place).mapInArrow(
        sets_of, "id long, k1 long, values binary")
    return found, classes, members, sets


def _rows(df: DataFrame, id_col: str, text_col: str, carry: bool = False) -> DataFrame:
    return df.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"),
                     (packed(df, id_col) if carry else F.lit(None).cast("string")).alias("row"))


def linked(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
           percent: int = PERCENT, carry: bool = False, links: bool = False) -> DataFrame:
    """``id, n_shingles, component_id`` for every row (and ``n_links`` if ``links``,
    ``row`` and a key of the component, ``joined``, if ``carry``)."""
    rows = _rows(df, id_col, text_col, carry)
    found, classes, members, sets = _searchable(rows, size, percent)
    edges = staged(links_of_blocks(members, sets, percent), "links")
    joined = components(edges.filter("links = 0").select("a", "b"))
    held = edges.filter("links > 0").groupBy(F.col("a").alias("node")).agg(
        F.sum("links").alias("links"))
    # The component's smallest identifier over its classes.
    named = classes.join(joined.join(held, "node"), classes.k1 == F.col("node")).select(
        "k1", "k2", "n", "rep", "component", "links")
    smallest = named.groupBy("component").agg(F.min("rep").alias("smallest"))
    named = named.join(smallest, "component").select("k1", "k2", "n", "smallest", "links",
                                                    "component")
    # Written, so that the last join can split a class that holds very many rows.
    label = staged(classes.join(named, ["k1", "k2", "n"], "left").select(
        "k1", "k2", "n", F.coalesce("smallest", "rep").alias("label"),
        (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links"),
        F.coalesce("component", "k1").alias("joined")), "labels")
    source = found if not carry else set_classes(rows, size)
    return source.join(label, ["k1", "k2", "n"], "left").select(
        "id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("label")).otherwise(F.col("id")).alias("component_id"),
        *([F.coalesce("links", F.lit(0)).alias("n_links")] if links else []),
        *(["row", "joined"] if carry else []))


def class_links(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
                percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Membership ``id, class_id`` (null: no shingles) and every pair ``a, b`` of linked classes."""
    found, _, members, sets = _searchable(_rows(df, id_col, text_col), size, percent)
    return (found.select("id", F.when(F.col("n") > 0, F.col("k1")).alias("class_id")),
            links_of_blocks(members, sets, percent, pairs=True))


def op9_ngram_join(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return linked(docs, links=True).withColumnRenamed("id", "doc_id")


def group_heads(docs: DataFrame) -> DataFrame:
    """One document of each group, its smallest identifier, with the columns of ``docs``.

    Of rows that share that identifier one stays, by their other columns. Texts
    without shingles are in no group and stay.
    """
    rows = linked(docs, carry=True).filter(F.col("id").eqNullSafe(F.col("component_id")))
    alone = F.when(F.col("n_shingles") == 0, F.monotonically_increasing_id())
    rows = rows.withColumn("alone", alone)
    order = Window.partitionBy("joined", "alone").orderBy(F.xxhash64("row"), "row")
    rows = rows.withColumn("nth", F.row_number().over(order)).filter("nth = 1")
    return rows.select(*[F.col("id").alias(c) if c == "doc_id" else F.col("row").getField(c).alias(c)
                         for c in docs.columns])
