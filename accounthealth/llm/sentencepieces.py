"""SentencePiece encoding and decoding with the N best segmentations.

The vocabulary comes from a public model file (its path is a parameter); a
piece's score is its log-probability under Zipf's law of its rank there. The
lattice of a text has an edge for every piece that matches, and for every
character without a piece one edge that falls back to its bytes.

No piece holds a non-space before a space, so the lattice falls apart into
segments (spaces, then what follows them) and the forward Viterbi pass runs
once for each distinct segment, many segments at a time (a task remembers those it
has met, within a bound). It gives
the best path and, with the backward pass, the loss of the second best. The
N best paths of a text differ from the best in the N - 1 segments of least loss
only; there the backward A-star search runs, whose heuristic, the forward
Viterbi score, is exact: paths leave the heap in order of their total score, and
an offset is visited N times at most. A segment's edges, scores and search are
linear in its length, so one very long run without spaces takes a task longer
but no more than a few hundred bytes a character.

A space is added before a text and taken off by decoding, which restores every
text byte by byte. Ties: the longer last piece wins; of segments of equal loss
the earlier one changes.

Defined results: null and empty texts have no pieces, score 0 and one
segmentation; decoding them gives the empty text. Rows that repeat are encoded
each; an empty table has no rows. Columns of any name pass through in ``row``.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accounthealth.llm.frames import packed
from accounthealth.llm.textbytes import BYTE_VALUES, _STEP, _powers, chunks, mixed, span_values

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
N_BEST = 3
SLOT_BITS = 20
FEW = 40  # segments of one length below which a plain loop is quicker
SPACE = 0x20
_MARK = "▁"


@dataclass
class Vocabulary:
    """pieces[id]: its bytes (spaces as spaces), or empty for control ids."""

    pieces: list[bytes]
    scores: np.ndarray
    byte_ids: np.ndarray  # id of each byte's fallback piece
    unknown: float  # score of an edge that falls back to bytes

    def __post_init__(self):
        self.edge_scores = [*self.scores.tolist(), self.unknown]  # the last one for piece -1
        control = set(self.byte_ids.tolist())
        self.index = {p: i for i, p in enumerate(self.pieces) if p and i not in control}
        self.longest = max(map(len, self.index))
        data = np.frombuffer(b"".join(self.index), np.uint8)
        end = np.cumsum([len(p) for p in self.index])
        self.values = np.zeros(len(self.pieces), np.uint64)
        ids = np.fromiter(self.index.values(), np.int64)
        self.values[ids] = span_values(data, end - np.diff(np.r_[0, end]), end)
        # Nearly all spans are no piece: a table of low bits tells most of them apart.
        self.maybe = np.zeros(1 << SLOT_BITS, bool)
        self.maybe[self._places(self.values[ids])[0]] = True
        # Three possible slots a piece; -1: free.
        self.slots = np.full(1 << SLOT_BITS, -1, np.int32)
        for i in ids:
            places = [int(s[0]) for s in self._places(self.values[i:i + 1])]
            free = [s for s in places if self.slots[s] < 0]
            if not free:
                raise ValueError("the piece table is too small for this vocabulary")
            self.slots[free[0]] = i

    @staticmethod
    def _places(values):
        low = np.uint64((1 << SLOT_BITS) - 1)
        return [(values >> np.uint64(k * SLOT_BITS)) & low for k in range(3)]

    def find(self, values: np.ndarray) -> np.ndarray:
        """Piece id of each span value, -1 if none."""
        out = np.full(values.shape, -1, np.int32)
        some = np.flatnonzero(self.maybe[values & np.uint64((1 << SLOT_BITS) - 1)])
        values = values[some]
        for place in self._places(values):
            at = self.slots[place]
            hit = (at >= 0) & (self.values[at] == values)
            out[some[hit]] = at[hit]
        return out

    @property
    def parts(self) -> tuple:
        return self.pieces, self.scores, self.byte_ids, self.unknown


def load(model_file: str = MODEL) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    count = model.get_piece_size()
    pieces, byte_ids, rank, ranks = [], np.full(256, -1, np.int64), 0, {}
    for i in range(count):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            pieces.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            pieces.append(b"")
        else:
            text = piece.replace(_MARK, " ")
            if " " in text.lstrip(" "):  # would join two segments
                text = ""
            rank += 1
            ranks[i] = rank
            pieces.append(text.encode())
    if (byte_ids < 0).any():
        raise ValueError("the model must have byte pieces")
    total = math.log(sum(1 / r for r in ranks.values()))
    scores = np.full(count, -1e9)
    for i, r in ranks.items():
        scores[i] = -math.log(r) - total
    return Vocabulary(pieces, scores, byte_ids, float(-math.log(rank) - total - 10))


# ---- one segment

def _char_length(lead: int) -> int:
    return 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


class Lattice:
    """The edges of a segment in flat arrays: those that end at offset j are
    ``first[j]:first[j + 1]``, the longest first; piece -1 falls back to bytes."""

    def __init__(self, v: Vocabulary, segment: bytes):
        self.v, self.segment = v, segment
        self.first, self.start, self.piece = array("q", [0]), array("q"), array("i")
        index, longest, size = v.index, max(v.longest, 4), len(segment)
        for j in range(size + 1):
            if j and (j == size or segment[j] & 0xC0 != 0x80):
                for i in range(max(0, j - longest), j):
                    lead = segment[i]
                    if lead & 0xC0 == 0x80:
                        continue
                    piece = index.get(segment[i:j])
                    if piece is not None:
                        self.start.append(i), self.piece.append(piece)
                    elif j == i + _char_length(lead):
                        self.start.append(i), self.piece.append(-1)
            self.first.append(len(self.start))

    def into(self, j: int):
        """(start, piece, score) of the edges that end at j."""
        a, b, scores = self.first[j], self.first[j + 1], self.v.edge_scores
        return [(i, p, scores[p]) for i, p in zip(self.start[a:b], self.piece[a:b], strict=True)]

    def ids(self, edges) -> list[int]:
        """Piece ids of edges (start, end, piece) in text order."""
        out = []
        for i, j, piece in edges:
            out += [piece] if piece >= 0 else self.v.byte_ids[list(self.segment[i:j])].tolist()
        return out


def forward(lattice: Lattice) -> list[float]:
    best = [0.0] + [-math.inf] * len(lattice.segment)
    for j in range(1, len(best)):
        for i, _, s in lattice.into(j):
            if best[i] + s > best[j]:
                best[j] = best[i] + s
    return best


def n_best(v: Vocabulary, segment: bytes, n: int,
           lattice: Lattice | None = None) -> list[tuple[float, list[int]]]:
    """The n best (score, ids) of a segment, best first: A-star from its end.

    The heuristic is exact, so the k-th visit of an offset has its k-th best
    end: no more than n visits can matter. A visit puts its best edge into the heap,
    and each edge taken out its next best, so the heap grows by two at most.
    """
    lattice = lattice or Lattice(v, segment)
    best, size = forward(lattice), len(segment)
    # Of a path's beginning (offset, score so far, path it extends, edge): flat, by number.
    at, tail, behind, edge = [size], [0.0], [-1], [(0, 0, 0)]
    visits, sorted_edges = {size: 1}, {}

    def edges(j):
        if j not in sorted_edges:
            sorted_edges[j] = sorted(((best[i] + s, i, p, s) for i, p, s in lattice.into(j)),
                                     key=lambda e: -e[0])
        return sorted_edges[j]

    heap, pushed, out = [], 0, []

    def push(path, nth):
        nonlocal pushed
        known = edges(at[path])
        if nth < len(known):
            pushed += 1
            # of equal totals the one nearest to the segment's start goes on
            heapq.heappush(heap, (-(known[nth][0] + tail[path]), known[nth][1], pushed, path, nth))

    if not size:
        return [(0.0, [])]
    push(0, 0)
    while heap and len(out) < n:
        _, i, _, path, nth = heapq.heappop(heap)
        push(path, nth + 1)
        if visits.get(i, 0) >= n:
            continue
        visits[i] = visits.get(i, 0) + 1
        _, _, piece, s = edges(at[path])[nth]
        at.append(i), tail.append(tail[path] + s), behind.append(path)
        edge.append((i, at[path], piece))
        own = len(at) - 1
        if i:
            push(own, 0)
            continue
        steps, k = [], own
        while behind[k] >= 0:
            steps.append(edge[k])
            k = behind[k]
        out.append((tail[own], lattice.ids(steps)))
    return out


def _best_alone(v: Vocabulary, segment: bytes) -> tuple[float, float, list[int]]:
    """(best score, loss of the second best path, ids) by a plain loop."""
    lattice = Lattice(v, segment)
    best, size = forward(lattice), len(segment)
    steps, j = [], size
    while j:
        i, piece = next((i, p) for i, p, s in lattice.into(j) if best[i] + s == best[j])  # longest
        steps.append((i, j, piece))
        j = i
    chosen = {(i, j) for i, j, _ in steps}
    back = [-math.inf] * size + [0.0]
    other = -math.inf
    for j in range(size, 0, -1):
        for i, _, s in lattice.into(j):
            if s + back[j] > back[i]:
                back[i] = s + back[j]
            if (i, j) not in chosen and best[i] + s + back[j] > other:
                other = best[i] + s + back[j]
    return best[-1], best[-1] - other, lattice.ids(reversed(steps))


# ---- many segments of one length

def _best_together(v: Vocabulary, rows: np.ndarray):
    """The same for the rows (segments of n bytes each): scores, losses, and
    the pieces as a table of the id that starts at each byte (-1: none)."""
    count, n = rows.shape
    power, inverse = _powers(1 << 16)
    columns = np.ascontiguousarray(rows.T)
    total = np.zeros((n + 1, count), np.uint64)
    np.cumsum(BYTE_VALUES[columns] * power[:n, None], axis=0, out=total[1:])
    # length of the character that begins at a byte, 0 inside one
    chars = np.select([columns < 0x80, columns < 0xC0, columns < 0xE0, columns < 0xF0],
                      [1, 0, 2, 3], 4).astype(np.int8)
    best = np.full((n + 1, count), -np.inf)
    best[0] = 0
    step = np.zeros((n + 1, count), np.int64)
    piece_at = np.full((n + 1, count), -1, np.int32)
    edges = []
    for j in range(1, n + 1):
        for i in range(max(0, j - max(v.longest, 4)), j):  # longest first
            value = total[j] - total[i]
            value *= inverse[i]
            value += np.uint64((j - i) * int(_STEP) % (1 << 64))
            ids = v.find(mixed(value))
            at = np.flatnonzero((ids >= 0) | (chars[i] == j - i) if j - i <= 4 else ids >= 0)
            if not len(at):
                continue
            ids = ids[at]
            score = np.where(ids >= 0, v.scores[ids], v.unknown)
            edges.append((i, j, at, score))
            reach = best[i, at] + score
            better = reach > best[j, at]
            up = at[better]
            best[j, up], step[j, up], piece_at[j, up] = reach[better], j - i, ids[better]
    back = np.full((n + 1, count), -np.inf)
    back[n] = 0
    for i, j, at, score in sorted(edges, key=lambda e: -e[1]):
        back[i, at] = np.maximum(back[i, at], score + back[j, at])
    # Walk the best paths back together.
    on_path = np.zeros((n + 1, count), np.int64)  # start + 1 of the path's edge to each end
    ids = np.full((count, n), -1, np.int32)
    at, every = np.full(count, n), np.arange(count)
    while len(every):
        start = at - step[at, every]
        on_path[at, every] = start + 1
        piece = piece_at[at, every]
        whole = piece >= 0
        ids[every[whole], start[whole]] = piece[whole]
        for k in np.flatnonzero(~whole):
            span = slice(start[k], at[k])
            ids[every[k], span] = v.byte_ids[rows[every[k], span]]
        go = start > 0
        every, at = every[go], start[go]
    other = np.full(count, -np.inf)
    for i, j, at, score in edges:
        off = at[on_path[j, at] != i + 1]
        through = best[i, off] + score[on_path[j, at] != i + 1] + back[j, off]
        other[off] = np.maximum(other[off], through)
    return best[n], best[n] - other, ids


def _ragged(flat: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """flat[begin:begin + count] of each entry, one after the other."""
    total = int(count.sum())
    at = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
    return flat[np.repeat(begin, count) + at]


class Known:
    """Best paths of the segments a task has met, by their 64-bit value. A segment's result is
    the same whenever it is found, so forgetting all of them only costs time."""

    MOST, MOST_IDS = 600_000, 6_000_000

    def __init__(self):
        self.forget()

    def forget(self) -> None:
        self.values, self.flat = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.score, self.loss = np.zeros(0), np.zeros(0)
        self.begin, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.paths: dict[int, list] = {}  # n best of some segments
        self.ids_held = 0  # ids in these paths

    def room(self) -> None:
        if len(self.values) > self.MOST or len(self.flat) + self.ids_held > self.MOST_IDS:
            self.forget()

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, whether it is there) of each value."""
        at = np.searchsorted(self.values, values)
        if not len(self.values):
            return at, np.zeros(len(values), bool)
        at[at == len(self.values)] = 0
        return at, self.values[at] == values

    def add(self, values, score, loss, begin, count, ids) -> None:
        """New segments, ``values`` sorted; ``begin`` counts from the ids added last."""
        at = np.searchsorted(self.values, values)
        for name, new in (("score", score), ("loss", loss), ("count", count),
                          ("begin", begin + len(self.flat)), ("values", values)):
            setattr(self, name, np.insert(getattr(self, name), at, new))
        self.flat = np.concatenate([self.flat, *ids])


def _learn(v: Vocabulary, known: Known, values, data, start, lens) -> None:
    """Finds the best paths of new segments, many of one length at a time."""
    score, loss = np.empty(len(values)), np.empty(len(values))
    ids_of, begin, count = [], np.zeros(len(values), np.int64), np.zeros(len(values), np.int64)
    used, order = 0, np.argsort(lens, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(lens[order])) + 1) if len(order) else ():
        length = int(lens[group[0]])
        if len(group) <= FEW or length > 200:
            for g in group:
                score[g], loss[g], ids = _best_alone(v, data[start[g]:][:length].tobytes())
                ids_of.append(np.array(ids, np.int32))
                begin[g], count[g] = used, len(ids)
                used += len(ids)
            continue
        for part in np.split(group, range(20_000, len(group), 20_000)):
            rows = data[start[part][:, None] + np.arange(length)]
            score[part], loss[part], table = _best_together(v, rows)
            has = table >= 0
            count[part] = has.sum(axis=1)
            begin[part] = used + np.cumsum(count[part]) - count[part]
            ids_of.append(table[has])
            used += int(count[part].sum())
    known.add(values, score, loss, begin, count, ids_of)


def encode_chunk(v: Vocabulary, chunk, n: int, known: Known | None = None):
    """(ids, offsets, n best (score, number of pieces, changes)) of a chunk's texts.

    changes: (segment's first piece, its pieces, its other pieces) against the best.
    """
    known = known or Known()
    known.room()
    size = np.diff(chunk.edges)
    some = size > 0
    edges = chunk.edges + np.r_[0, np.cumsum(some)]  # with a space before each text
    data = np.full(len(chunk.data) + int(some.sum()), SPACE, np.uint8)
    at = np.arange(len(chunk.data)) + np.repeat(np.cumsum(some), size)
    data[at] = chunk.data
    if not len(data):
        return np.zeros(0, np.int32), np.zeros(chunk.rows + 1, np.int64), [[(0.0, 0, [])]] * chunk.rows
    space = data == SPACE
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    begins[edges[:-1][some]] = True
    start = np.flatnonzero(begins)
    end = np.r_[start[1:], len(data)]
    values, where, which = np.unique(span_values(data, start, end), return_index=True,
                                     return_inverse=True)
    _, there = known.find(values)
    _learn(v, known, values[~there], data, start[where[~there]], (end - start)[where[~there]])
    at, _ = known.find(values)
    lens, flat_ids = (end - start)[where], known.flat
    score, loss, begin, count = (x[at] for x in (known.score, known.loss, known.begin, known.count))
    ids = _ragged(flat_ids, begin[which], count[which])
    total = np.r_[0, np.cumsum(count[which])]
    first = np.searchsorted(start, edges)
    nbest = []
    for k in range(chunk.rows):
        a, b = first[k], first[k + 1]
        base = float(score[which[a:b]].sum())
        found = [(0.0, 0, [])]
        if n > 1 and b > a:
            own = loss[which[a:b]]
            top = np.argpartition(own, min(n - 1, len(own)) - 1)[:n - 1] if len(own) > n else \
                np.arange(len(own))
            limit = own[top].max()
            near = np.flatnonzero(own <= limit)
            for s in near[np.argsort(own[near], kind="stable")][:n - 1]:
                g = int(which[a + s])
                name = int(values[g])
                if name not in known.paths:  # the best one as found, then those that differ
                    own_ids = flat_ids[begin[g]:begin[g] + count[g]].tolist()
                    paths = n_best(v, data[start[where[g]]:][:lens[g]].tobytes(), n)
                    known.paths[name] = [(paths[0][0], own_ids),
                                         *[p for p in paths if p[1] != own_ids][:n - 1]]
                    known.ids_held += n * len(own_ids)
                base_loss = known.paths[name][0][0]
                spot = (int(total[a + s] - total[a]), int(count[g]))
                found = sorted(
                    ((lost + base_loss - alt, more + (len(p) - spot[1] if r else 0),
                      change + [(*spot, p)] if r else change)
                     for lost, more, change in found
                     for r, (alt, p) in enumerate(known.paths[name])),
                    key=lambda x: x[0])[:n]
        pieces = int(total[b] - total[a])
        nbest.append([(base - lost, pieces + more, change) for lost, more, change in found])
    return ids, total[first], nbest


def decode_ids(v: Vocabulary, ids) -> str:
    """The text of piece ids."""
    data = b"".join(v.pieces[i] for i in ids)
    return (data[1:] if data[:1] == b" " else data).decode("utf-8", errors="replace")


# ---- on Spark

def encoded(df: DataFrame, text_col: str = "text", model_file: str = MODEL, n: int = N_BEST,
            full: bool = False) -> DataFrame:
    """``row`` (all columns of ``df``), ``ids``, ``nbest`` (score, n_pieces, and the
    ids if ``full``), ``decoded`` (decoding gives the text back) for every row."""
    rows = df.select(packed(df).alias("row"))
    best = T.StructType([T.StructField("score", T.DoubleType()),
                         T.StructField("n_pieces", T.IntegerType())]
                        + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * full)
    schema = T.StructType([
        rows.schema["row"], T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("ids_sha256", T.StringType()), T.StructField("nbest", T.ArrayType(best)),
        T.StructField("decoded", T.BooleanType())])
    shared = df.sparkSession.sparkContext.broadcast(load(model_file).parts)  # a vocabulary

    def run(batches):
        v, known = Vocabulary(*shared.value), Known()
        sizes = np.array([len(p) for p in v.pieces])
        flat = np.frombuffer(b"".join(v.pieces), np.uint8)
        begin = np.cumsum(sizes) - sizes
        kind = pa.struct([("score", pa.float64()), ("n_pieces", pa.int32())]
                         + [("ids", pa.list_(pa.int32()))] * full)
        for batch in batches:
            for c in chunks(batch.column(0).field(text_col)):
                ids, edges, nbest = encode_chunk(v, c, n, known)
                ids = ids.astype(np.int32)
                text = _ragged(flat, begin[ids], sizes[ids])  # decoding, all texts at once
                at = np.r_[0, np.cumsum(sizes[ids])][edges]
                same, sha, lists = [], [], []
                for k in range(c.rows):
                    source = c.data[c.edges[k]:c.edges[k + 1]]
                    back = text[at[k]:at[k + 1]]
                    same.append(len(back) == 0 == len(source)
                                or bool(back[0] == SPACE and np.array_equal(back[1:], source)))
                    own = ids[edges[k]:edges[k + 1]]
                    sha.append(hashlib.sha256(own.tobytes()).hexdigest())
                    lists.append([{"score": s, "n_pieces": p}
                                  | ({"ids": _changed(own, change)} if full else {})
                                  for s, p, change in nbest[k]])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(c.row, c.rows),
                     pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(ids)),
                     pa.array(sha), pa.array(lists, pa.list_(kind)), pa.array(same)],
                    names=["row", "ids", "ids_sha256", "nbest", "decoded"])

    return rows.mapInArrow(run, schema)


def _changed(ids: np.ndarray, changes) -> list[int]:
    out, at = [], 0
    for first, count, other in sorted(changes):
        out += [*ids[at:first].tolist(), *other]
        at = first + count
    return out + ids[at:].tolist()


def decoded(df: DataFrame, ids_col: str = "ids", model_file: str = MODEL) -> DataFrame:
    """``row`` (all columns of ``df``) and ``text`` decoded from its ids (null: null)."""
    rows = df.select(packed(df).alias("row"))
    schema = T.StructType([rows.schema["row"], T.StructField("text", T.StringType())])
    shared = df.sparkSession.sparkContext.broadcast(load(model_file).parts)

    def run(batches):
        v = Vocabulary(*shared.value)
        for batch in batches:
            texts = [None if x is None else decode_ids(v, x)
                     for x in batch.column(0).field(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], names=["row", "text"])

    return rows.mapInArrow(run, schema)


def piece_counts(docs: DataFrame, model_file: str = MODEL, n: int = N_BEST) -> DataFrame:
    """One row per document: pieces, scores of the n best, and the round trip."""
    found = encoded(docs.select("doc_id", "text"), model_file=model_file, n=n)
    return found.select(
        F.col("row.doc_id").alias("doc_id"), F.size("ids").cast("long").alias("n_pieces"),
        "ids_sha256", F.col("nbest.score").alias("scores"),
        F.col("nbest.n_pieces").alias("nbest_pieces"), F.col("decoded").alias("round_trip"))


def op3_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return piece_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
