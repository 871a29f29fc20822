"""Substring dedup with a compressed FM-index per shard.

A window is ``LENGTH`` consecutive words. Every word covered by a window whose
word sequence also starts anywhere else goes, judged on the input texts.

1. Pieces. Each window is dealt by its minimiser, the least value of the runs
   of ``GRAM`` words inside it (the first, on ties). Consecutive windows with
   one minimiser form a piece, so each window lies in exactly one piece and
   equal windows meet in the same shard. Pieces whose minimiser occurs once in
   the corpus cannot hold a repeat and are dropped before any word is moved.
2. Contents. Equal pieces are one content with a number of copies, found by a
   128-bit value of their words. A content's words are read from one of its
   documents and sent to its shard once, however hot it is.
3. Index. A shard's contents, those with copies twice, separated, are sorted by
   their suffixes (to more words than a window has), and the Burrows-Wheeler
   string is kept as a wavelet tree of bit vectors with counts a block. All
   contents are streamed against it: backward search extends a window to the
   left while it occurs twice; where it stops, all windows that hold the stopped
   run are skipped.
   As a piece is shorter than two windows, its repeats are one interval, from
   the first to the last repeated window.
4. A minimiser whose contents alone exceed a shard (a common run of words in
   ever different surroundings) is not one shard: its contents' windows are dealt
   by a 128-bit value each and counted, which spreads them over all tasks.
5. The intervals return to every document that holds the content.

Words are compared by 64-bit values, rows are told apart by a 64-bit value of
identifier and text, so repeated identifiers are separate documents.

Defined results: a null or blank text has no words; its kept text is empty. Rows
without an identifier are documents like others; rows that repeat an identifier and
a text are copies of each other. An empty table has no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accounthealth.llm.frames import quoted, staged
from accounthealth.llm.textbytes import Chunk, _powers, chunks, mixed, run_values, word_values

LENGTH = 35  # words of a window
GRAM = 6
PLACE_BITS = 30  # a text has at most 2 ** 31 bytes, so fewer words than 2 ** 30
SHARD_WORDS = 1_500_000
_SECOND = np.uint64(0xD6E8FEB86659FD93)


# ---- pieces

def _least(packed: np.ndarray, span: int) -> np.ndarray:
    """Minimum of every ``span`` consecutive entries."""
    width, out = 1, packed
    while 2 * width <= span:
        out = np.minimum(out[:-width], out[width:])
        width *= 2
    rest = span - width
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def pieces(words: np.ndarray, first: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(text, start, windows, minimiser) of the pieces; start counts the text's words."""
    none = np.zeros(0, np.int64)
    if len(words) < length:
        return none, none, none, np.zeros(0, np.uint64)
    grams = run_values(words, gram)
    # The same bits in every chunk, so that equal windows choose alike.
    bits = np.uint64(PLACE_BITS)
    place = np.arange(len(grams), dtype=np.uint64)
    least = _least((grams >> bits << bits) | place, length - gram + 1)
    at = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    starts = np.arange(len(at))
    inside = starts + length <= first[1:][text[:len(at)]]
    starts, at, text = starts[inside], at[inside], text[:len(at)][inside]
    if not len(starts):
        return none, none, none, np.zeros(0, np.uint64)
    new = np.r_[True, (at[1:] != at[:-1]) | (text[1:] != text[:-1])]
    begin = np.flatnonzero(new)
    windows = np.diff(np.r_[begin, len(starts)])
    return text[begin], starts[begin] - first[:-1][text[begin]], windows, grams[at[begin]]


def content_values(words: np.ndarray, start: np.ndarray, count: np.ndarray):
    """Two 64-bit values of each run of words."""
    power, inverse = _powers(1 << max(16, int(len(words)).bit_length()))
    out = []
    for values in (words, mixed(words ^ _SECOND)):
        total = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(values * power[:len(words)], out=total[1:])
        out.append(mixed((total[start + count] - total[start]) * inverse[start]
                         + count.astype(np.uint64)).view(np.int64))
    return out


def _piece_rows(texts: DataFrame, length: int) -> DataFrame:
    """``rid, start, windows, mini, d1, d2`` for every piece of every text."""
    def run(batches):
        for batch in batches:
            rid = batch.column("rid").to_numpy()
            for chunk in chunks(batch.column("text")):
                words = word_values(chunk)
                text, start, windows, mini = pieces(words, chunk.first, length)
                d1, d2 = content_values(words, chunk.first[text] + start, windows + length - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid[chunk.row + text]), pa.array(start.astype(np.int32)),
                     pa.array(windows.astype(np.int32)), pa.array(mini.view(np.int64)),
                     pa.array(d1), pa.array(d2)],
                    names=["rid", "start", "windows", "mini", "d1", "d2"])

    return texts.mapInArrow(
        run, "rid long, start int, windows int, mini long, d1 long, d2 long")


# ---- index

class WaveletTree:
    """Ranks over a sequence of small integers: a bit vector a level, the most
    significant bit first, entries regrouped by bit from level to level."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.levels = bits, []
        for level in range(bits - 1, -1, -1):
            bit = ((values >> level) & 1).astype(np.uint8)
            packed = np.packbits(bit, bitorder="little")
            words = np.zeros(len(bit) // 64 + 1, np.uint64)
            words.view(np.uint8)[:len(packed)] = packed
            ones = np.zeros(len(words) + 1, np.int32)
            np.cumsum(np.bitwise_count(words), out=ones[1:])
            zeros = len(bit) - int(ones[-1])
            self.levels.append((words, ones, zeros))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    @staticmethod
    def _ones(words, ones, at):
        block = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return ones[block] + np.bitwise_count(words[block] & low)

    def ranks(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        lo = np.zeros_like(at)
        for level, (words, ones, zeros) in zip(range(self.bits - 1, -1, -1), self.levels, strict=True):
            one = ((symbol >> level) & 1).astype(bool)
            r_at, r_lo = self._ones(words, ones, at), self._ones(words, ones, lo)
            at = np.where(one, zeros + r_at, at - r_at)
            lo = np.where(one, zeros + r_lo, lo - r_lo)
        return at - lo


class FMIndex:
    """Backward search over a sequence of symbols (0 separates contents)."""

    def __init__(self, text: np.ndarray, depth: int):
        n = len(text)
        rank, width = text.astype(np.int64), 1
        while width < depth:
            ahead = np.zeros(n, np.int64)
            ahead[:n - width] = rank[width:] + 1
            key = rank * np.int64(int(rank.max(initial=0)) + 2) + ahead
            order = np.argsort(key, kind="stable")
            sorted_key = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.r_[0, (sorted_key[1:] != sorted_key[:-1]).astype(np.int64)])
            width *= 2
        suffixes = np.argsort(rank, kind="stable")
        self.tree = WaveletTree(text[suffixes - 1], max(1, int(text.max(initial=0)).bit_length()))
        self.before = np.r_[0, np.cumsum(np.bincount(text))]
        self.size = n

    def extend(self, symbol, lo, hi):
        """The interval of ``symbol`` + pattern from the pattern's."""
        ranks = self.tree.ranks(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        base = self.before[symbol]
        return base + ranks[:len(lo)], base + ranks[len(lo):]


def repeated_spans(text: np.ndarray, begin: np.ndarray, windows: np.ndarray,
                   length: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last repeated window of the asked contents (-1: none).

    text: all indexed contents with separators; begin: where the asked ones start.
    """
    first = np.full(len(begin), -1)
    last = np.full(len(begin), -1)
    lanes = np.arange(len(begin))
    if not len(lanes):
        return first, last
    index = FMIndex(text, length)
    at = np.zeros(len(lanes), np.int64)  # window under test
    upward = np.ones(len(lanes), bool)  # looking for the first, then for the last
    used = np.zeros(len(lanes), np.int64)  # words matched
    lo, hi = np.zeros(len(lanes), np.int64), np.full(len(lanes), index.size)
    while len(lanes):
        symbol = text[begin[lanes] + at + length - 1 - used].astype(np.int64)
        lo, hi = index.extend(symbol, lo, hi)
        used += 1
        fail = hi - lo < 2
        found = ~fail & (used == length)
        # a failed run spans words at+length-used .. at+length-1: windows that start
        # up to its first word hold it
        first[lanes[found & upward]] = at[found & upward]
        last[lanes[found]] = at[found]
        done = found & (~upward | (at == windows[lanes] - 1))
        turn = found & upward & ~done
        at = np.where(fail & upward, at + length - used + 1, np.where(fail, at - 1, at))
        at = np.where(turn, windows[lanes] - 1, at)
        done |= fail & upward & (at >= windows[lanes])
        done |= fail & ~upward & (at <= first[lanes])  # the first is the last, too
        upward &= ~turn
        fresh = fail | turn
        used = np.where(fresh, 0, used)
        lo, hi = np.where(fresh, 0, lo), np.where(fresh, index.size, hi)
        go = ~done
        lanes, at, upward, used, lo, hi = (x[go] for x in (lanes, at, upward, used, lo, hi))
    return first, last


# ---- on Spark

def _with_rid(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    ident, text = F.col(quoted(id_col)), F.coalesce(F.col(quoted(text_col)), F.lit(""))
    return df.select(F.xxhash64(ident, text).alias("rid"), ident.alias("id"), text.alias("text"))


def repeated_intervals(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """``rid, spans`` (word intervals to remove) for the texts that have any."""
    spark = texts.sparkSession
    found = _piece_rows(texts.select("rid", "text"), length)
    # Counted before the exchange, so a hot minimiser is one row a task. The counts
    # are written, not joined where they were made: Spark splits the hot partitions
    # of a join only if both sides come straight from their exchanges.
    shared = staged(found.groupBy("mini").agg(F.count(F.lit(1)).alias("n"))
                    .filter("n > 1").select("mini"), "minimisers")
    held = staged(found.join(shared, "mini"), "pieces")
    contents = staged(held.groupBy("mini", "d1", "d2", "windows").agg(
        F.count(F.lit(1)).alias("copies"),
        F.min(F.struct("rid", "start")).alias("at")), "contents")
    # words that a content takes in an index, copied contents twice
    words = (F.col("windows") + length) * F.least(F.col("copies"), F.lit(2))
    volume = contents.agg(F.sum(words)).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), volume // SHARD_WORDS + 1)
    crowded = staged(contents.groupBy("mini").agg(F.sum(words).alias("volume"))
                     .filter(F.col("volume") > SHARD_WORDS).select("mini"), "crowded")

    def with_wanted(some: DataFrame) -> DataFrame:
        """``text, want`` of the documents that the contents are read from."""
        wanted = some.groupBy(F.col("at.rid").alias("rid")).agg(F.collect_list(F.struct(
            F.col("at.start").alias("start"), "windows", "mini", "d1", "d2", "copies")).alias("want"))
        return texts.select("rid", "text").join(wanted, "rid").select("text", "want")

    def read_words(batches):
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                out = {k: [] for k in ("mini", "d1", "d2", "windows", "copies", "words")}
                words = word_values(chunk)
                for k in range(chunk.rows):
                    for w in batch.column("want")[chunk.row + k].as_py():
                        lo = chunk.first[k] + w["start"]
                        out["words"].append(words[lo:lo + w["windows"] + length - 1].tobytes())
                        for name in ("mini", "d1", "d2", "windows", "copies"):
                            out[name].append(w[name])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["mini"], pa.int64()), pa.array(out["d1"], pa.int64()),
                     pa.array(out["d2"], pa.int64()), pa.array(out["windows"], pa.int32()),
                     pa.array(out["copies"], pa.int64()), pa.array(out["words"], pa.binary())],
                    names=list(out))

    moved = with_wanted(contents.join(crowded, "mini", "left_anti")).mapInArrow(
        read_words, "mini long, d1 long, d2 long, windows int, copies long, words binary")

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates(["mini", "d1", "d2"])  # a rid may come twice
        rows = [np.frombuffer(w, np.uint64) for w in frame["words"]]
        rows += [rows[k] for k in np.flatnonzero(frame["copies"].to_numpy() > 1)]
        count = np.array([len(r) for r in rows])
        begin = np.r_[0, np.cumsum(count + 1)[:-1]]
        _, dense = np.unique(np.concatenate(rows), return_inverse=True)
        text = np.zeros(int(count.sum()) + len(rows), np.int64)
        text[np.arange(len(dense)) + np.repeat(np.arange(len(rows)), count)] = dense + 1
        windows = frame["windows"].to_numpy()
        first, last = repeated_spans(text, begin[:len(frame)], windows, length)
        out = frame[["mini", "d1", "d2"]].assign(lo=first, hi=last + length)
        return out[first >= 0].astype({"lo": "int32", "hi": "int32"})

    hits = (moved.withColumn("shard", F.pmod(F.xxhash64("mini"), F.lit(shards)))
            .groupBy("shard").applyInPandas(search, "mini long, d1 long, d2 long, lo int, hi int"))
    if not crowded.isEmpty():
        hits = hits.unionByName(_counted_spans(
            with_wanted(contents.join(crowded, "mini", "left_semi")), length))
    return held.join(hits, ["mini", "d1", "d2"]).groupBy("rid").agg(F.collect_set(F.struct(
        (F.col("start") + F.col("lo")).alias("lo"),
        (F.col("start") + F.col("hi")).alias("hi"))).alias("spans"))


def _counted_spans(wanted: DataFrame, length: int) -> DataFrame:
    """``mini, d1, d2, lo, hi`` of the contents wanted from texts (``text, want``),
    by counting the values of their windows."""
    def read_windows(batches):
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                want = [(k, w) for k in range(chunk.rows)
                        for w in batch.column("want")[chunk.row + k].as_py()]
                count = np.array([w["windows"] for _, w in want])
                begin = np.array([chunk.first[k] + w["start"] for k, w in want])
                nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                w1, w2 = content_values(word_values(chunk), np.repeat(begin, count) + nth,
                                        np.full(len(nth), length))
                own = [pa.array(np.repeat(np.array([w[name] for _, w in want], np.int64), count))
                       for name in ("mini", "d1", "d2", "copies")]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(nth.astype(np.int32)), pa.array(w1), pa.array(w2)],
                    names=["mini", "d1", "d2", "copies", "nth", "w1", "w2"])

    windows = staged(wanted.mapInArrow(
        read_windows, "mini long, d1 long, d2 long, copies long, nth int, w1 long, w2 long"),
        "windows")
    again = staged(windows.groupBy("w1", "w2").agg(F.sum("copies").alias("n"))
                   .filter("n > 1").select("w1", "w2"), "repeated")
    return windows.join(again, ["w1", "w2"]).groupBy("mini", "d1", "d2").agg(
        F.min("nth").alias("lo"), (F.max("nth") + length).cast("int").alias("hi"))


def _kept_bytes(chunk: Chunk, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the kept words, one space between, and each text's offsets."""
    size = len(chunk.data)
    mark = np.zeros(size + 1, np.int32)
    start, end = chunk.start[keep], chunk.end[keep]
    text = np.repeat(np.arange(chunk.rows), np.diff(chunk.first))[keep]
    follows = np.zeros(len(start), bool)
    follows[:-1] = text[1:] == text[:-1]
    np.add.at(mark, start, 1)
    np.add.at(mark, end + follows, -1)  # the white space after a word becomes the space
    inside = np.cumsum(mark[:size]) > 0
    data = chunk.data.copy()
    data[end[follows]] = 0x20
    total = np.r_[0, np.cumsum(inside)]
    return data[inside], total[chunk.edges]


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    length: int = LENGTH) -> DataFrame:
    """``id, n_words, n_removed, kept_text, kept_sha256`` for every row."""
    texts = _with_rid(df, id_col, text_col)
    spans = repeated_intervals(texts, length)
    kind = dict(texts.dtypes)["id"]

    def cut(batches):
        for batch in batches:
            spans = batch.column("spans")
            lens = spans.value_lengths().fill_null(0).to_numpy()
            flat = spans.flatten()
            lo, hi = (flat.field(k).to_numpy() for k in (0, 1))
            edges = np.r_[0, np.cumsum(lens)]
            for c in chunks(batch.column("text")):
                kept, sha = [], []
                a, b = edges[c.row], edges[c.row + c.rows]
                base = np.repeat(c.first[:-1], lens[c.row:c.row + c.rows])
                mark = np.zeros(len(c.start) + 1, np.int64)
                np.add.at(mark, base + lo[a:b], 1)
                np.add.at(mark, base + hi[a:b], -1)
                keep = np.cumsum(mark[:-1]) == 0
                data, at = _kept_bytes(c, keep)
                total = np.r_[0, np.cumsum(keep)]
                words = np.diff(c.first)
                gone = words - np.diff(total[c.first])
                for x, y in zip(at[:-1], at[1:], strict=True):
                    text = data[x:y].tobytes()
                    kept.append(text)
                    sha.append(hashlib.sha256(text).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(c.row, c.rows), pa.array(words, pa.int64()),
                     pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()),
                     pa.array(sha, pa.string())],
                    names=["id", "n_words", "n_removed", "kept_text", "kept_sha256"])

    return texts.join(spans, "rid", "left").select("id", "text", "spans").mapInArrow(
        cut, f"id {kind}, n_words long, n_removed long, kept_text string, kept_sha256 string")


def op10_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return without_repeats(docs).select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")
