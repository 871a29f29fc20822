"""Sequences filled with lexically related documents.

1. Tokens. Every text is tokenised whole and ended by ``END``. Full rows of a
   long document are sequences of their own; its rest, shorter than a row, is a
   unit to pack. Units are written once.
2. Statistics. BM25 needs the number of units that hold a token, the number of
   units and their mean length: counted over all units, one sum a token, so the
   result is bounded by the vocabulary.
3. Shards. A unit's sketch is its token of least weighted hash (rare ids of the
   vocabulary weigh more), so units that share rare tokens tend to share it. The
   token counts of the sketches (again one a token) cut the units into shards
   of about ``SHARD_TOKENS``: neighbouring sketches together, a sketch with more
   over several shards by a hash of the row.
4. Packing. A shard has an inverted index (token, units, weights) of its own. The
   next unused unit in order is the seed of a window; its tokens are the query,
   and unused neighbours fill the window by falling BM25 score. The last one is
   cut to fit and its rest is the next seed, so every window is full. What is
   left at the end of a shard is cut at powers of two, which need no padding.

Token ids are those of the public vocabulary file read by ``tokenizers``; the
same vocabulary is read by the faster ``tiktoken``, which gives the same ids for
every code point (tested), and ``tokenizers`` itself takes the texts that the
other refuses (a very long run of white space).

Defined results: a null or empty text is ``END`` alone. Ties in score go to the
earlier unit; units are in order of sketch, row hash and row number. Rows that
repeat an identifier, or have none, are documents of their own, told apart by
``row``. An empty table has no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accounthealth.llm.frames import quoted, staged
from accounthealth.llm.textbytes import mixed

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
# Fixed by the vocabulary: how it splits text into words. Fixed by the contract: the end id.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END = 1
ROW = 2048
SHARD_TOKENS = 1 << 18
UNIT_TOKENS = 64  # what a unit counts besides its tokens, so that a shard's units are bounded too
BATCH_TOKENS = 1 << 21  # tokens handed on at once
K1, B = 1.2, 0.75  # the usual parameters of BM25


# ---- tokens

def byte_characters() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable Latin-1 bytes stand
    for themselves, the others for the characters from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(moved)}


class Tokens:
    """Ids of texts, as ``tokenizers`` gives them for the vocabulary file."""

    def __init__(self, content: str):
        import tiktoken

        self.content, self.exact = content, None
        model = json.loads(content)
        special = {t["content"]: t["id"] for t in model["added_tokens"]}
        of = byte_characters()
        ranks = {bytes(of[c] for c in word): k for word, k in model["model"]["vocab"].items()
                 if word not in special}
        self.size = 1 + max([*ranks.values(), *special.values()])
        self.fast = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks,
                                      special_tokens=special)

    def ids(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:  # its regular expressions have a limit that the other's do not
            if self.exact is None:
                from tokenizers import Tokenizer

                self.exact = Tokenizer.from_str(self.content)
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)


def sketch_weights(size: int) -> np.ndarray:
    """For each id an exponential draw over its weight: the least of a set is its sketch."""
    ids = np.arange(size, dtype=np.uint64)
    draw = (mixed(ids + np.uint64(1)) >> np.uint64(11)).astype(np.float64) / (1 << 53)
    return -np.log(draw + 2.0 ** -54) / np.square(np.log2(2.0 + np.arange(size)))


def pieces(df: DataFrame, id_col: str, text_col: str, vocabulary: str, row: int) -> DataFrame:
    """``row, id, start, whole, size, ids, doc_tokens, sketch``: the full rows of every document
    (``whole``) and its rest; ids are little-endian unsigned 16-bit."""
    with open(vocabulary, encoding="utf-8") as source:
        content = source.read()
    shared = df.sparkSession.sparkContext.broadcast(content)  # a vocabulary

    def run(batches):
        tokens = Tokens(shared.value)
        if tokens.size > 1 << 16:
            raise ValueError("ids of the vocabulary must fit in 16 bits")
        draws = sketch_weights(tokens.size)
        for batch in batches:
            out, held = _Rows(), 0
            for k, text in enumerate(batch.column("text")):
                ids = np.append(tokens.ids(text.as_py() or ""), END).astype("<u2")
                for lo in range(0, len(ids), row):
                    part = ids[lo:lo + row]
                    whole = len(part) == row
                    words = part if whole else part[:-1]
                    sketch = -1 if whole or not len(words) else int(words[draws[words].argmin()])
                    out.add(k, lo, whole, part, len(ids), sketch)
                    held += len(part)
                    if held >= BATCH_TOKENS:
                        yield out.batch(batch)
                        out, held = _Rows(), 0
            if held:
                yield out.batch(batch)

    rows = df.select(F.monotonically_increasing_id().alias("row"),
                     F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"))
    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(run, f"row long, id {kind}, start long, whole boolean, size int, "
                           "ids binary, doc_tokens long, sketch int")


class _Rows:
    def __init__(self):
        self.at, self.columns = [], [[] for _ in range(6)]

    def add(self, at, start, whole, ids, doc_tokens, sketch):
        self.at.append(at)
        for column, value in zip(self.columns, (start, whole, len(ids), ids.tobytes(), doc_tokens,
                                                sketch), strict=True):
            column.append(value)

    def batch(self, source: pa.RecordBatch) -> pa.RecordBatch:
        at = pa.array(self.at, pa.int64())
        kinds = [pa.int64(), pa.bool_(), pa.int32(), pa.binary(), pa.int64(), pa.int32()]
        return pa.RecordBatch.from_arrays(
            [source.column("row").take(at), source.column("id").take(at),
             *[pa.array(c, kind) for c, kind in zip(self.columns, kinds, strict=True)]],
            names=["row", "id", "start", "whole", "size", "ids", "doc_tokens", "sketch"])


# ---- statistics and shards

def holders(units: DataFrame) -> np.ndarray:
    """Number of units that hold each id, over all units (as long as the vocabulary)."""
    def count(batches):
        held = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for blob in batch.column("ids"):
                held[np.unique(np.frombuffer(blob.as_buffer(), "<u2")[:-1])] += 1
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(held[some])],
                                         names=["token", "units"])

    rows = units.select("ids").mapInArrow(count, "token long, units long")
    found = rows.groupBy("token").agg(F.sum("units").alias("units")).toArrow()
    out = np.zeros(1 << 16, np.int64)
    out[found.column("token").to_numpy()] = found.column("units").to_numpy()
    return out


def shard_table(sizes: dict[int, int], shard_tokens: int) -> list[tuple[int, int, int]]:
    """``(sketch, first shard, shards)`` from the tokens of each sketch."""
    out, shard, room = [], 0, shard_tokens
    for sketch in sorted(sizes):
        many = -(-sizes[sketch] // shard_tokens)
        if many > 1 or room < sizes[sketch]:
            shard, room = shard + (room < shard_tokens), shard_tokens
        out.append((sketch, shard, many))
        if many > 1:
            shard += many
        else:
            room -= sizes[sketch]
    return out


# ---- one shard

class Index:
    """Inverted index of a shard's units: BM25 scores of the unused ones for a unit's tokens."""

    def __init__(self, units: list[np.ndarray], held: np.ndarray, count: int, mean: float):
        counted = [np.unique(u[:-1], return_counts=True) for u in units]
        lengths = np.array([len(u) for u in units], np.float64)
        unit = np.repeat(np.arange(len(units)), [len(t) for t, _ in counted])
        token = np.concatenate([t for t, _ in counted]) if counted else np.zeros(0, np.uint16)
        times = np.concatenate([c for _, c in counted]).astype(np.float64) if counted else token
        rare = np.log1p((count - held[token] + 0.5) / (held[token] + 0.5))
        weight = rare * times * (K1 + 1) / (times + K1 * (1 - B + B * lengths[unit] / mean))
        self.names, place = np.unique(token, return_inverse=True)
        self.first = np.cumsum([0, *[len(t) for t, _ in counted]])
        self.place = place  # list number of each unit's tokens
        order = np.argsort(place, kind="stable")
        self.unit, self.weight = unit[order], weight[order]
        self.edges = np.searchsorted(place[order], np.arange(len(self.names) + 1))
        self.used, self.gone = np.zeros(len(units), bool), 0

    def use(self, unit: int) -> None:
        self.used[unit] = True
        self.gone += 1
        if 2 * self.gone > len(self.used) - self.used.sum() + self.gone:  # lists half used
            keep = ~self.used[self.unit]
            total = np.r_[0, np.cumsum(keep)]
            self.unit, self.weight = self.unit[keep], self.weight[keep]
            self.edges, self.gone = total[self.edges], 0

    def scores(self, unit: int) -> np.ndarray:
        """The score of every unit for the tokens of ``unit``; used ones -1."""
        lists = self.place[self.first[unit]:self.first[unit + 1]]
        begin = self.edges[lists]
        many = self.edges[lists + 1] - begin
        at = np.arange(many.sum()) + np.repeat(begin - np.cumsum(many) + many, many)
        out = np.bincount(self.unit[at], weights=self.weight[at], minlength=len(self.used))
        out[self.used] = -1
        return out


def best_first(scores: np.ndarray) -> Iterator[int]:
    """Units by falling score, ties by number; those with a score below 0 are left out.
    Sorts no more than it is asked for."""
    live, some = np.flatnonzero(scores >= 0), 16
    while len(live):
        own = scores[live]
        least = np.partition(own, len(own) - some)[len(own) - some] if len(own) > some else own.min()
        take = live[own >= least]
        yield from take[np.argsort(-scores[take], kind="stable")].tolist()
        live, some = live[own < least], 4 * some


def fill(units: list[np.ndarray], held: np.ndarray, count: int, mean: float,
         row: int) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences as lists of (unit, first token, tokens), all full but for the last ones."""
    index = Index(units, held, count, mean)
    rest, nth = None, 0
    while True:
        while nth < len(units) and index.used[nth]:
            nth += 1
        if rest is None:
            if nth == len(units):
                return
            rest = (nth, 0)
            index.use(nth)
        seed, begin = rest
        window, room = [(seed, begin, len(units[seed]) - begin)], row - len(units[seed]) + begin
        rest = None
        for best in best_first(index.scores(seed)) if room else ():
            size = len(units[best])
            index.use(best)
            window.append((best, 0, min(size, room)))
            if size > room:
                rest = (best, room)
            room -= min(size, room)
            if not room:
                break
        if not room:
            yield window
        else:
            yield from powers(window)


def powers(window: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """A window that is not full, cut into sequences whose sizes are powers of two."""
    total = sum(size for _, _, size in window)
    left = list(reversed(window))
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        out = []
        while room:
            unit, begin, size = left.pop()
            take = min(size, room)
            out.append((unit, begin, take))
            room -= take
            if size > take:
                left.append((unit, begin + take, size - take))
        yield out


# ---- on Spark

_OUT = "row long, id {kind}, start long, length long, ids binary, doc_tokens long, " \
    "sequence_id long, offset long"


def packed_pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  vocabulary: str = VOCABULARY, row: int = ROW,
                  shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per piece: ``row, id, start, length, ids, doc_tokens, sequence_id, offset``;
    ``ids`` are little-endian unsigned 32-bit, ``start`` counts the document's ids before it,
    ``offset`` the sequence's. ``sequence_id`` is odd for packed sequences (the shard's number
    and the sequence's in it) and even for the full rows of long documents."""
    spark = df.sparkSession
    every = staged(pieces(df, id_col, text_col, vocabulary, row), "token-pieces")
    out = _OUT.format(kind=dict(every.dtypes)["id"])
    units = every.filter("not whole")
    held = holders(units)
    sums = units.groupBy("sketch").agg(F.sum("size").cast("long").alias("tokens"),
                                       F.count(F.lit(1)).alias("units")).collect()  # one a token
    count = max(1, sum(r.units for r in sums))
    mean = max(1.0, sum(r.tokens - r.units for r in sums) / count)
    shared = spark.sparkContext.broadcast((held, count, mean))  # as long as the vocabulary
    table = spark.createDataFrame(
        shard_table({r.sketch: r.tokens + UNIT_TOKENS * r.units for r in sums}, shard_tokens),
        "sketch int, base long, shards long")  # one row a token of the vocabulary
    draw = F.xxhash64("id", "ids", "row")
    dealt = units.withColumn("draw", draw).join(F.broadcast(table), "sketch").withColumn(
        "shard", F.col("base") + F.pmod("draw", "shards")).select(
        "shard", "sketch", "draw", "row", "id", "start", "ids", "doc_tokens")

    # More sequences than twice a shard's tokens can fill, and the powers of two.
    bits = (4 * shard_tokens // row + 64).bit_length()

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("sketch", "draw", "row")])
        blobs = [np.frombuffer(b.as_buffer(), "<u2") for b in table.column("ids")]
        base = table.column("shard")[0].as_py() << bits
        at, begin, size, ids, sequence, offset = [], [], [], [], [], []
        for nth, window in enumerate(fill(blobs, *shared.value, row)):
            place = 0
            if nth >> bits:
                raise ValueError("a shard has more sequences than its numbers")
            for unit, first, many in window:
                at.append(unit), begin.append(first), size.append(many)
                ids.append(blobs[unit][first:first + many].astype("<u4").tobytes())
                sequence.append((base | nth) * 2 + 1), offset.append(place)
                place += many
        at = pa.array(at, pa.int64())
        start = table.column("start").take(at).to_numpy() + np.array(begin, np.int64)
        return pa.table({
            "row": table.column("row").take(at), "id": table.column("id").take(at),
            "start": pa.array(start, pa.int64()), "length": pa.array(size, pa.int64()),
            "ids": pa.array(ids, pa.binary()), "doc_tokens": table.column("doc_tokens").take(at),
            "sequence_id": pa.array(sequence, pa.int64()), "offset": pa.array(offset, pa.int64())})

    packed = dealt.groupBy("shard").applyInArrow(pack, out)

    def widen(batches):
        for batch in batches:
            ids = [np.frombuffer(b.as_buffer(), "<u2").astype("<u4").tobytes()
                   for b in batch.column("ids")]
            yield batch.set_column(batch.schema.get_field_index("ids"), "ids",
                                   pa.array(ids, pa.binary()))

    full = every.filter("whole").select(
        "row", "id", "start", F.col("size").cast("long").alias("length"), "ids", "doc_tokens",
        (F.monotonically_increasing_id() * 2).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(full.mapInArrow(widen, T.StructType(list(full.schema.fields))))


def op12_packing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return packed_pieces(docs).select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset", F.col("row").alias("row_id"))
