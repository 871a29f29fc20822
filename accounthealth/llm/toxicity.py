"""Toxicity scores from a small bidirectional gated recurrent network (numpy).

Inputs, one step a word: a trained word vector (hashed table, letters folded)
and two trained character inputs, the strongest evidence among the word's
character 4-grams and 5-grams. The evidence tables and the first component of
the word vectors start from shrunken log-odds of the labelled sample; all of
them are moved by the network's gradients. A gated recurrent layer runs in both
directions over a window, attention pools its states, and a logistic unit gives
the window's probability. A document's score is the largest over all its
overlapping windows, one at every word, so it does not depend on where a passage
stands; a text shorter than a window is one window. What the network makes of
one word's input alone is computed once for the windows that share the word.

Training sees only document labels: in each round the highest windows of each
document are chosen with the current network and the network is fitted to them
(back-propagation through time, Adam). The sample is bounded by
``max_positive`` and ``max_negative`` labelled documents, chosen by a hash of
the identifier. Labels, language, source and identifier are never inputs.

Defined results: a null, empty or blank text scores 0, a very long one like any
other, window by window. Rows that repeat are scored each; a null identifier is
scored and counts as not held out. Labels that repeat an identifier count as
toxic if one of them is 1; null labels are left out. If the sample lacks one of
the classes every score is 0. An empty table has no rows.
"""

from __future__ import annotations

import math
import pickle
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accounthealth.llm.frames import packed
from accounthealth.llm.textbytes import BYTE_VALUES, LOWER, IS_SPACE, Chunk, chunks, word_values

WINDOW = 12  # words
UNITS, WORD_DIMS = 8, 4
GRAM_BITS = 18
WORD_ROWS, GRAM_ROWS = 1 << 15, 1 << GRAM_BITS
GRAMS = (4, 5)
MAX_POSITIVE, MAX_NEGATIVE = 1200, 3600
TRAIN_BYTES = 1 << 20  # of text worked on at once while fitting
THRESHOLD = 0.7
BATCH = 128  # windows of a training step, half of them from toxic texts
LANES = 2048  # windows that step together


@dataclass
class Model:
    words: np.ndarray  # (WORD_ROWS, WORD_DIMS)
    grams: list[np.ndarray]  # for each n of GRAMS: (GRAM_ROWS + 1,), the last for no n-gram
    params: dict[str, np.ndarray] = field(default_factory=dict)


# ---- inputs

def gram_rows(chunk: Chunk) -> list[np.ndarray]:
    """Table row of the n-gram that starts at each byte, for each n of GRAMS;
    GRAM_ROWS where it would leave the word or the text."""
    data = LOWER[chunk.data]
    value = (BYTE_VALUES >> np.uint64(32)).astype(np.uint32)[data]
    space = IS_SPACE[data]
    out, total, blocked, have = [], value, space, 1
    for n in GRAMS:
        rows = np.full(len(data), GRAM_ROWS, np.uint32)
        size = len(data) - n + 1
        if size > 0:
            total, blocked = total[:size].copy(), blocked[:size].copy()
            for k in range(have, n):
                total *= np.uint32(0x9E3779B1)
                total += value[k:k + size]
                blocked |= space[k:k + size]
            have = n
            np.right_shift(total, np.uint32(32 - GRAM_BITS), out=rows[:size])
            rows[:size][blocked] = GRAM_ROWS
            for k in range(1, n):
                at = chunk.edges[1:-1] - k
                rows[at[at >= 0]] = GRAM_ROWS
        out.append(rows)
    return out


def word_rows(chunk: Chunk) -> np.ndarray:
    return (word_values(chunk, fold=True) >> np.uint64(49)).astype(np.int64)


def best_grams(model: Model, chunk: Chunk) -> list[np.ndarray]:
    """For each n of GRAMS the table row of every word's strongest n-gram (GRAM_ROWS: none)."""
    out = []
    for table, rows in zip(model.grams, gram_rows(chunk), strict=True):
        value = table[rows]
        best = np.maximum.reduceat(value, chunk.start)
        # the word's first byte with that value
        word = np.repeat(np.arange(len(chunk.start)), np.diff(np.r_[chunk.start, len(value)]))
        at = np.flatnonzero(value[chunk.start[0]:] == best[word]) + chunk.start[0]
        first = np.searchsorted(at, chunk.start)
        out.append(rows[at[first]])
    return out


def features(model: Model, chunk: Chunk) -> np.ndarray:
    """One row of inputs for each word of the chunk, and a last row of zeros."""
    n = len(chunk.start)
    out = np.zeros((n + 1, WORD_DIMS + len(GRAMS)), np.float32)
    if not n:
        return out
    out[:n, :WORD_DIMS] = model.words[word_rows(chunk)]
    for k, rows in enumerate(gram_rows(chunk)):
        best = np.maximum.reduceat(model.grams[k][rows], chunk.start)
        out[:n, WORD_DIMS + k] = np.where(best > -1e8, best, 0)
    return out


def window_starts(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, text) of the windows of the texts with words first[k]:first[k+1]: one at
    each word that a whole window begins with, one for a shorter text."""
    count = np.diff(first)
    per = np.where(count > 0, np.maximum(1, count - WINDOW + 1), 0)
    text = np.repeat(np.arange(len(count)), per)
    nth = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    return first[text] + nth, np.minimum(count[text], WINDOW), text


# ---- the network

def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def _squash(x):
    """The states' activation, x / (1 + |x|): ten times as fast as tanh here.
    Its slope at output s is (1 - |s|) ** 2."""
    return x / (1 + np.abs(x))


def _gate(x):
    return 0.5 + 0.5 * _squash(x)


def _gate_slope(g):
    return 0.5 * np.square(1 - np.abs(2 * g - 1))


def start_params(rng: np.random.Generator) -> dict[str, np.ndarray]:
    dims = WORD_DIMS + len(GRAMS)
    out = {}
    for way in ("f", "b"):
        out[f"x{way}"] = rng.normal(0, 0.3, (dims, 3 * UNITS))
        out[f"h{way}"] = rng.normal(0, 0.2, (UNITS, 3 * UNITS))
        out[f"c{way}"] = np.zeros(3 * UNITS)
    out["attend"] = rng.normal(0, 0.1, 2 * UNITS)
    out["out"] = rng.normal(0, 0.3, 2 * UNITS)
    out["bias"] = np.zeros(1)
    return {k: v.astype(np.float32) for k, v in out.items()}


def _step(p: dict, way: str):
    """(recurrence of one step, weights of attention and output) of one direction."""
    inner = np.ascontiguousarray(p[f"h{way}"].T)
    side = slice(0, UNITS) if way == "f" else slice(UNITS, 2 * UNITS)
    heads = np.stack([p["attend"][side], p["out"][side]])

    def step(given, h):
        """The next states from the words' share ``given`` of the gates and the states h."""
        own = inner @ h
        gates = given[:2 * UNITS] + own[:2 * UNITS]
        gates /= 1 + np.abs(gates)
        gates *= 0.5
        gates += 0.5
        new = gates[UNITS:]
        new *= own[2 * UNITS:]
        new += given[2 * UNITS:]
        new /= 1 + np.abs(new)
        own = h - new
        own *= gates[:UNITS]
        own += new
        return own

    return step, heads


def _pooled(both: np.ndarray, bias: float) -> np.ndarray:
    """Logits from attention and output terms (steps, 2, windows)."""
    e = np.exp(both[:, 0] - both[:, 0].max(axis=0))
    return (e * both[:, 1]).sum(axis=0) / e.sum(axis=0) + bias


def window_logits(p: dict, inputs: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Logits of any windows over word inputs whose last row is padding."""
    out = np.empty(len(start), p["out"].dtype)
    table, pad = np.ascontiguousarray(inputs.T), len(inputs) - 1
    steps = int(length.max(initial=0))
    for lo in range(0, len(start), LANES):
        s, n = start[lo:lo + LANES], length[lo:lo + LANES]
        both = np.zeros((steps, 2, len(s)), p["out"].dtype)
        for way in "fb":
            step, heads = _step(p, way)
            h = np.zeros((UNITS, len(s)), p["out"].dtype)
            for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
                on = t < n
                x = table[:, np.where(on, s + t, pad)]
                h = np.where(on, step(p[f"x{way}"].T @ x + p[f"c{way}"][:, None], h), h)
                both[t] += heads @ h
        both[:, 0][np.arange(steps)[:, None] >= n] = -1e9
        out[lo:lo + LANES] = _pooled(both, p["bias"][0])
    return out


def position_logits(p: dict, inputs: np.ndarray) -> np.ndarray:
    """Logits of the windows of WINDOW words that begin at each word of ``inputs``, texts aside.

    A word's input products are taken once for all windows that hold it."""
    count = len(inputs) - WINDOW + 1
    if count <= 0:
        return np.zeros(0, np.float32)
    out = np.empty(count, np.float32)
    table = np.ascontiguousarray(inputs.T)
    for lo in range(0, count, LANES):
        m = min(LANES, count - lo)
        x = table[:, lo:lo + m + WINDOW - 1]
        both = np.zeros((WINDOW, 2, m), np.float32)
        for way in "fb":
            step, heads = _step(p, way)
            given = np.ascontiguousarray(p[f"x{way}"].T) @ x + p[f"c{way}"][:, None]
            h = np.zeros((UNITS, m), np.float32)
            for t in range(WINDOW) if way == "f" else range(WINDOW - 1, -1, -1):
                h = step(given[:, t:t + m], h)
                both[t] += heads @ h
        out[lo:lo + m] = _pooled(both, p["bias"][0])
    return out


def all_logits(p: dict, inputs: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Logits of the windows of ``window_starts``: the whole ones by position, the short ones alone."""
    out = np.empty(len(start), np.float32)
    whole = length == WINDOW
    out[whole] = position_logits(p, inputs[:-1])[start[whole]]
    short = np.flatnonzero(~whole)
    out[short] = window_logits(p, inputs, start[short], length[short])
    return out


def _gradients(p: dict, x: np.ndarray, on: np.ndarray, label: np.ndarray):
    """Mean logistic loss's gradients for windows x (steps, windows, inputs)."""
    steps, lanes, _ = x.shape
    kept, states = {}, np.zeros((steps, lanes, 2 * UNITS), np.float32)
    for way in "fb":
        h = np.zeros((lanes, UNITS), np.float32)
        order = range(steps) if way == "f" else range(steps - 1, -1, -1)
        side = slice(0, UNITS) if way == "f" else slice(UNITS, 2 * UNITS)
        for t in order:
            a = x[t] @ p[f"x{way}"] + p[f"c{way}"]
            g = h @ p[f"h{way}"]
            z, r = np.split(_gate(a[:, :2 * UNITS] + g[:, :2 * UNITS]), 2, axis=1)
            n = _squash(a[:, 2 * UNITS:] + r * g[:, 2 * UNITS:])
            kept[way, t] = (h, z, r, n, g[:, 2 * UNITS:])
            h = np.where(on[t][:, None], n + z * (h - n), h)
            states[t, :, side] = h
    e = np.where(on, states @ p["attend"], -1e9)
    w = np.exp(e - e.max(axis=0))
    w /= w.sum(axis=0)
    pooled = (w[:, :, None] * states).sum(axis=0)
    logit = pooled @ p["out"] + p["bias"][0]
    wrong = (_sigmoid(logit) - label) / lanes
    grad = {"out": pooled.T @ wrong, "bias": np.array([wrong.sum()], np.float32)}
    to_pooled = wrong[:, None] * p["out"]
    to_e = w * ((states - pooled) * to_pooled).sum(axis=2)
    grad["attend"] = (to_e[:, :, None] * states).sum(axis=(0, 1))
    to_states = w[:, :, None] * to_pooled + to_e[:, :, None] * p["attend"]
    to_x = np.zeros_like(x)
    for way in "fb":
        order = range(steps - 1, -1, -1) if way == "f" else range(steps)
        side = slice(0, UNITS) if way == "f" else slice(UNITS, 2 * UNITS)
        dx, dh, dc = (np.zeros_like(p[f"{k}{way}"]) for k in "xhc")
        back = np.zeros((lanes, UNITS), np.float32)
        for t in order:
            h, z, r, n, gn = kept[way, t]
            back = back + to_states[t, :, side]
            live = on[t][:, None]
            d = np.where(live, back, 0)
            dn = d * (1 - z) * np.square(1 - np.abs(n))
            dz = d * (h - n) * _gate_slope(z)
            dr = dn * gn * _gate_slope(r)
            da = np.concatenate([dz, dr, dn], axis=1)
            dg = np.concatenate([dz, dr, dn * r], axis=1)
            dx += x[t].T @ da
            dh += h.T @ dg
            dc += da.sum(axis=0)
            to_x[t] += da @ p[f"x{way}"].T
            back = np.where(live, d * z + dg @ p[f"h{way}"].T, back)
        grad[f"x{way}"], grad[f"h{way}"], grad[f"c{way}"] = dx, dh, dc
    return grad, to_x


class _Adam:
    def __init__(self, rate: float):
        self.rate, self.step, self.seen = rate, 0, {}

    def move(self, params: dict, grads: dict) -> None:
        self.step += 1
        fix = math.sqrt(1 - 0.999 ** self.step) / (1 - 0.9 ** self.step)
        for k, g in grads.items():
            m, v = self.seen.setdefault(k, (np.zeros_like(params[k]), np.zeros_like(params[k])))
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            params[k] -= (self.rate * fix * m / (np.sqrt(v) + 1e-8)).astype(np.float32)


class _Evidence:
    """Shrunken log-odds of table rows, counted over texts a chunk at a time."""

    def __init__(self, rows: int, label: np.ndarray):
        self.label, self.rows = label, rows
        self.held = np.zeros((2, rows))  # texts of each class that hold a row

    def add(self, text: np.ndarray, row: np.ndarray) -> None:
        pairs = np.unique(text * self.rows + row)
        text, row = pairs // self.rows, pairs % self.rows
        for k in (0, 1):
            self.held[k] += np.bincount(row[self.label[text] == k], minlength=self.rows)

    def odds(self) -> np.ndarray:
        good, bad = self.held
        ratio = (self.label == 0).sum() / (self.label == 1).sum()
        odds = np.log((bad + 1) / (good + 1) * ratio)
        return np.clip(odds * (bad + good) / (bad + good + 8), -2, 6).astype(np.float32)


def train(texts: list[str | None], labels: list[int], rounds: int = 4, steps: int = 100,
          seed: int = 1) -> Model | None:
    """Fits the network to labelled texts; None if a class is missing."""
    label = np.asarray(labels, dtype=np.int64)
    if not (label == 1).any() or not (label == 0).any():
        return None
    rng = np.random.default_rng(seed)
    texts = pa.array(texts, pa.large_string())
    by_word, by_gram = _Evidence(WORD_ROWS, label), [_Evidence(GRAM_ROWS, label) for _ in GRAMS]
    total = 0
    for c in chunks(texts, TRAIN_BYTES):
        total += len(c.start)
        by_word.add(np.repeat(np.arange(c.rows) + c.row, np.diff(c.first)), word_rows(c))
        for evidence, rows in zip(by_gram, gram_rows(c), strict=True):
            at = np.flatnonzero(rows < GRAM_ROWS)
            text = c.row + np.searchsorted(c.edges, at, side="right") - 1
            evidence.add(text, rows[at].astype(np.int64))
    if not total:
        return None
    words = rng.normal(0, 0.05, (WORD_ROWS, WORD_DIMS)).astype(np.float32)
    words[:, 0] = by_word.odds()
    model = Model(words, [np.append(g.odds(), np.float32(-1e9)) for g in by_gram],
                  start_params(rng))
    # The words of all sampled texts fit in memory, so inputs are built once a round.
    rows = np.empty(total, np.int32)
    starts, lengths, owners, base = [], [], [], 0
    for c in chunks(texts, TRAIN_BYTES):
        s, n, t = window_starts(c.first)
        rows[base:base + len(c.start)] = word_rows(c)
        starts.append(s + base), lengths.append(n), owners.append(t + c.row)
        base += len(c.start)
    start, length, owner = map(np.concatenate, (starts, lengths, owners))
    adam, slow = _Adam(0.01), 0.02
    for turn in range(rounds):
        x, grams = _inputs(model, texts, total)
        if turn == 0:
            rank = _strongest(x[:, 0] + x[:, WORD_DIMS:].max(axis=1), start, length)
        else:
            rank = all_logits(model.params, x, start, length)
        order = np.lexsort((-rank, owner))
        first = np.r_[True, owner[order][1:] != owner[order][:-1]]
        nth = np.arange(len(order)) - np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
        toxic = label[owner[order]] == 1
        pools = [order[toxic & (nth < 1)], order[~toxic & (nth < 3)]]
        for _ in range(steps):
            if all(map(len, pools)):
                w = np.concatenate([rng.choice(pool, BATCH // 2) for pool in pools])
                at = np.where(np.arange(WINDOW)[:, None] < length[w],
                              start[w] + np.arange(WINDOW)[:, None], len(x) - 1)
                on = at < len(x) - 1
                grads, to_x = _gradients(model.params, x[at], on, label[owner[w]])
                adam.move(model.params, grads)
                for table, row, part in [
                        (model.words, rows, slice(0, WORD_DIMS)),
                        *((g, best, slice(WORD_DIMS + k, WORD_DIMS + k + 1))
                          for k, (g, best) in enumerate(zip(model.grams, grams, strict=True)))]:
                    hit, back = np.unique(row[at[on]], return_inverse=True)
                    change = np.zeros((len(hit), part.stop - part.start), np.float32)
                    np.add.at(change, back, to_x[on][:, part])
                    change = slow * np.clip(change * BATCH, -1, 1)
                    if table.ndim == 1:  # n-grams; the last row means none and stays
                        table[hit] -= np.where(hit < GRAM_ROWS, change[:, 0], 0)
                    else:
                        table[hit] -= change
    return model


def _inputs(model: Model, texts: pa.Array, total: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Inputs of all words of the texts, and the n-grams they come from."""
    x = np.zeros((total + 1, WORD_DIMS + len(GRAMS)), np.float32)
    grams, base = [np.empty(total, np.int32) for _ in GRAMS], 0
    for c in chunks(texts, TRAIN_BYTES):
        stop = base + len(c.start)
        x[base:stop] = features(model, c)[:-1]
        if stop > base:
            for own, best in zip(grams, best_grams(model, c), strict=True):
                own[base:stop] = best
        base = stop
    return x, grams


def _strongest(value: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The largest word value of each window; the last value is padding."""
    out = np.full(len(start), -np.inf, np.float32)
    for t in range(WINDOW):
        on = t < length
        out[on] = np.maximum(out[on], value[start[on] + t])
    return out


def scores(model: Model | None, texts: pa.Array) -> np.ndarray:
    """The largest window probability of each text (no words: 0)."""
    out = np.zeros(len(texts))
    if model is None:
        return out
    for c in chunks(texts):
        start, length, text = window_starts(c.first)
        if len(start):
            logit = all_logits(model.params, features(model, c), start, length)
            begin = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
            best = np.maximum.reduceat(logit, begin).astype(np.float64)
            out[c.row + text[begin]] = _sigmoid(best)
    return out


# ---- on Spark

def is_held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE,
                    max_negative: int = MAX_NEGATIVE) -> DataFrame:
    """``text, toxic`` of the training sample: never a held-out row."""
    known = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
             .filter(F.col("toxic").isin(0, 1) & ~is_held_out("doc_id"))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    known = known.withColumn("draw", F.xxhash64("doc_id"))
    some = [known.filter(F.col("toxic") == k).orderBy("draw", "doc_id").limit(n)
            for k, n in ((1, max_positive), (0, max_negative))]
    ids = some[0].unionByName(some[1]).select("doc_id", "toxic")
    # at most max_positive + max_negative rows
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select(
        "doc_id", "text", "toxic")


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, **bounds) -> Model | None:
    """Fits in one task, as the sample is bounded; the model, of fixed size, comes back."""
    def run(batches):
        rows = [r for batch in batches for r in zip(
            *(batch.column(k).to_pylist() for k in ("doc_id", "text", "toxic")), strict=True)]
        rows.sort(key=lambda r: (r[0], r[1] or ""))
        if rows:
            model = train([r[1] for r in rows], [r[2] for r in rows])
            blob = model and pickle.dumps((model.words, model.grams, model.params))
            yield pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], names=["model"])

    sample = labelled_sample(docs, labels, **bounds)
    row = sample.repartition(1).mapInArrow(run, "model binary").first()
    return Model(*pickle.loads(row.model)) if row and row.model else None


def scored(df: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``row`` (all columns of ``df``) and ``score`` for every input row."""
    rows = df.select(packed(df).alias("row"))
    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])
    plain = model and (model.words, model.grams, model.params)
    shared = df.sparkSession.sparkContext.broadcast(plain)  # of fixed size

    def run(batches):
        model = shared.value and Model(*shared.value)
        for batch in batches:
            row = batch.column(0)
            found = scores(model, row.field(text_col))
            yield pa.RecordBatch.from_arrays([row, pa.array(found)], names=["row", "score"])

    return rows.mapInArrow(run, schema)


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit(spark, docs, labels)
    found = scored(docs.select("doc_id", "text"), model)
    return found.select(
        F.col("row.doc_id").alias("doc_id"), is_held_out("row.doc_id").alias("held_out"),
        "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def clean_documents(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with the columns of ``docs``."""
    return scored(docs, model).filter(F.col("score") < threshold).select("row.*")
