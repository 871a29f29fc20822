"""Toxicity, pieces, packing, archives, neighbours, the pipeline and the oracle."""

import base64
import hashlib
import io
import math
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from accounthealth.llm import frames, multi_index, packing, sentencepieces, toxicity, warc
from accounthealth.llm.textbytes import chunks, word_values
from tests.conftest import SF001, SF0001


def test_words_of_chunks():
    import re

    texts = ["a  b\tc", None, "", " x", "é ü  y", "b" * 50, "a b"]
    for size in (1, 8, 1 << 20):
        seen, found = {}, {}
        for c in chunks(pa.array(texts).slice(0), size):
            values = word_values(c)
            for k in range(c.rows):
                found[c.row + k] = values[c.first[k]:c.first[k + 1]].tolist()
        for k, t in enumerate(texts):
            own = re.findall(r"[^\x20\x09-\x0D]+", t or "")
            assert len(own) == len(found[k])
            for w, v in zip(own, found[k], strict=True):
                assert seen.setdefault(w, v) == v
        assert len(set(seen.values())) == len(seen)


# ---- toxicity

def insults(rng, n):
    """Texts with and without words of a hidden stem."""
    syllables = ["ba", "to", "ri", "ne", "lu", "so", "mi"]
    def word():
        return "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
    out = []
    for k in range(n):
        text = [word() for _ in range(rng.randrange(1, 150))]
        if k % 3 == 0:
            text[rng.randrange(len(text))] = "zgrak" + word()
        out.append((" ".join(text), int(k % 3 == 0)))
    return out


def test_network_learns_stems_and_scores_every_window():
    rng = random.Random(1)
    model = toxicity.train(*zip(*insults(rng, 400), strict=True), rounds=2, steps=60)
    fresh = insults(rng, 150)
    scores = toxicity.scores(model, pa.array([t for t, _ in fresh]))
    right = [(s >= toxicity.THRESHOLD) == (y == 1) for s, (_, y) in zip(scores, fresh, strict=True)]
    assert np.mean(right) > 0.95
    clean = " ".join(t for t, y in fresh if not y)
    for text in (clean + " zgrakba", "zgrakba " + clean, clean + " zgrakba " + clean):
        assert toxicity.scores(model, pa.array([text]))[0] >= toxicity.THRESHOLD
    odd = toxicity.scores(model, pa.array([None, "", " \n", clean]))
    assert odd[:3].tolist() == [0, 0, 0] and 0 <= odd[3] <= 1


def plain_score(model, text):
    """The score by a loop over every window, direction, step and unit."""
    chunk = next(iter(toxicity.chunks(pa.array([text]))), None)
    if chunk is None or not len(chunk.start):
        return 0.0
    x, p, units = toxicity.features(model, chunk)[:-1].astype(float), model.params, toxicity.UNITS
    soft = lambda v: v / (1 + abs(v))
    best = -math.inf
    for begin in range(max(1, len(x) - toxicity.WINDOW + 1)):
        window = x[begin:begin + toxicity.WINDOW]
        states = np.zeros((len(window), 2 * units))
        for way, order in (("f", range(len(window))), ("b", reversed(range(len(window))))):
            h = [0.0] * units
            for t in order:
                given = [sum(window[t][d] * float(p[f"x{way}"][d][k]) for d in range(x.shape[1]))
                         + float(p[f"c{way}"][k]) for k in range(3 * units)]
                own = [sum(h[j] * float(p[f"h{way}"][j][k]) for j in range(units))
                       for k in range(3 * units)]
                gate = [0.5 + 0.5 * soft(given[k] + own[k]) for k in range(2 * units)]
                new = [soft(given[2 * units + k] + gate[units + k] * own[2 * units + k])
                       for k in range(units)]
                h = [new[k] + gate[k] * (h[k] - new[k]) for k in range(units)]
                states[t, 0 if way == "f" else units:][:units] = h
        weight = [math.exp(float(np.dot(states[t], p["attend"]))) for t in range(len(window))]
        pooled = sum(w * states[t] for t, w in enumerate(weight)) / sum(weight)
        best = max(best, float(np.dot(pooled, p["out"]) + p["bias"][0]))
    return 1 / (1 + math.exp(-best))


def test_scores_against_a_plain_loop(monkeypatch):
    """All windows of texts of any length, also with blocks smaller than a text."""
    rng = random.Random(8)
    model = toxicity.train(*zip(*insults(rng, 120), strict=True), rounds=2, steps=20)
    texts = [None, "", " ", "one", "a zgrakto b", *(t for t, _ in insults(rng, 9))]
    texts += [" ".join(["ba"] * n) for n in (toxicity.WINDOW - 1, toxicity.WINDOW, toxicity.WINDOW + 1)]
    want = [plain_score(model, t or "") for t in texts]
    for lanes in (2048, 3):
        monkeypatch.setattr(toxicity, "LANES", lanes)
        assert toxicity.scores(model, pa.array(texts)) == pytest.approx(want, abs=1e-4)


def test_a_passage_scores_alike_at_every_offset():
    """Wherever it stands, a passage lies whole in the same windows."""
    rng = random.Random(9)
    model = toxicity.train(*zip(*insults(rng, 300), strict=True), rounds=2, steps=40)
    filler, passage = ["ba"] * 60, ["ri", "zgrakba", "lu", "toso", "zgrakri"]
    texts = [" ".join(filler[:k] + passage + filler[k:]) for k in range(61)]
    found = toxicity.scores(model, pa.array(texts))
    inner = found[toxicity.WINDOW:-toxicity.WINDOW]
    assert inner.max() - inner.min() < 1e-5
    assert len({s >= toxicity.THRESHOLD for s in found}) == 1


def test_character_tables_are_trained():
    rng = random.Random(10)
    texts, labels = zip(*insults(rng, 200), strict=True)
    before = toxicity.train(texts, labels, rounds=1, steps=0)
    after = toxicity.train(texts, labels, rounds=2, steps=30)
    for a, b in zip(before.grams, after.grams, strict=True):
        assert (a != b).any() and a[-1] == b[-1] == np.float32(-1e9)


def test_gradients_by_differences():
    rng = np.random.default_rng(2)
    p = {k: v.astype(np.float64) for k, v in toxicity.start_params(rng).items()}
    x = rng.normal(size=(5, 3, toxicity.WORD_DIMS + 2))
    on = np.arange(5)[:, None] < np.array([5, 3, 1])
    y = np.array([1, 0, 1])

    def loss():
        inputs = np.concatenate([x.transpose(1, 0, 2).reshape(15, -1), np.zeros((1, x.shape[2]))])
        z = toxicity.window_logits(p, inputs, np.array([0, 5, 10]), on.sum(axis=0)).astype(float)
        return float(np.mean(np.log1p(np.exp(-(2 * y - 1) * z))))

    grads, to_x = toxicity._gradients(p, x, on, y)
    for name, g in [*grads.items(), ("input", to_x)]:
        value = x if name == "input" else p[name]
        at = tuple(int(rng.integers(0, s)) for s in value.shape)
        if name == "input":
            at = (0, 1, at[2])
        old, step = value[at], 1e-2
        value[at] = old + step
        up = loss()
        value[at] = old - step
        down = loss()
        value[at] = old
        assert np.asarray(g)[at] == pytest.approx((up - down) / (2 * step), abs=2e-3)


def test_held_out_accuracy(llm):
    """Every third labelled document is never learnt from."""
    got = {r.doc_id: r for r in toxicity.op1_toxicity(llm, SF001).collect()}
    labels = {r.doc_id: r.toxic for r in llm.read.parquet(f"{SF001}/labels.parquet").collect()}
    assert len(got) == llm.read.parquet(f"{SF001}/documents.parquet").count()
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [(got[i].score, y) for i, y in labels.items() if got[i].held_out]
    bad, good = [s for s, y in held if y], [s for s, y in held if not y]
    area = np.mean([(b > g) + (b == g) / 2 for b in bad for g in good])
    assert area > 0.8  # 33 toxic documents to learn from


def test_toxicity_without_a_class(docs_of, llm):
    docs = docs_of([(1, "a", "s"), (2, None, "s")])
    labels = llm.createDataFrame([(1, 0, 0), (2, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(llm, docs, labels)
    assert model is None
    assert toxicity.clean_documents(docs, model).collect() == docs.collect()
    assert toxicity.scored(docs_of([]), model).count() == 0
    none = llm.createDataFrame([(None, "x"), (None, "x")], "doc_id long, text string")
    held = none.select(toxicity.is_held_out("doc_id").alias("h")).collect()
    assert [r.h for r in held] == [False, False]
    assert toxicity.scored(none, model).count() == 2


# ---- pieces

@pytest.fixture(scope="module")
def vocabulary():
    return sentencepieces.load()


def every_path(v, segment):
    lattice = sentencepieces.Lattice(v, segment)

    def paths(j):
        if j == 0:
            yield 0.0, ()
        for i, piece, score in lattice.into(j):
            for total, path in paths(i):
                yield total + score, (*path, (i, j, piece))

    return sorted(paths(len(segment)), key=lambda x: -x[0])


@pytest.mark.parametrize("text", [" the", " hello", "  ▁é€x", " aaaa", "\n\t", " \U0001f600z"])
def test_n_best_against_all_paths(vocabulary, text):
    v, segment = vocabulary, text.encode()
    brute = every_path(v, segment)
    found = sentencepieces.n_best(v, segment, 5)
    assert [s for s, _ in found] == pytest.approx([s for s, _ in brute[:5]])
    score, loss, ids = sentencepieces._best_alone(v, segment)
    assert score == pytest.approx(brute[0][0])
    assert loss == pytest.approx(brute[0][0] - brute[1][0] if len(brute) > 1 else math.inf)
    rows = np.frombuffer(segment, np.uint8)[None].repeat(3, axis=0)
    many = sentencepieces._best_together(v, rows)
    assert many[0][1] == pytest.approx(score) and many[1][2] == pytest.approx(loss)
    assert many[2][0][many[2][0] >= 0].tolist() == ids


def test_n_best_of_a_text_against_all_paths(vocabulary):
    text = "ab cd ef"
    chunk = next(chunks(pa.array([text])))
    _, _, nbest = sentencepieces.encode_chunk(vocabulary, chunk, 4)
    brute = every_path(vocabulary, b" " + text.encode())
    assert [s for s, _, _ in nbest[0]] == pytest.approx([s for s, _ in brute[:4]])


@pytest.mark.parametrize("text,limit", [("a" * 5000, 5), ("ab" * 5000, 5), ("." * 20_000, 10),
                                        ("".join(chr(97 + k * k % 26) for k in range(60_000)), 30)])
def test_n_best_of_long_runs_is_quick(vocabulary, text, limit):
    """Equal scores by the thousand: the visits of an offset are bounded."""
    began = time.process_time()
    found = sentencepieces.n_best(vocabulary, b" " + text.encode(), 3)
    assert time.process_time() - began < limit
    assert len({tuple(ids) for _, ids in found}) == 3
    assert all(sentencepieces.decode_ids(vocabulary, ids) == text for _, ids in found)
    assert [s for s, _ in found] == sorted((s for s, _ in found), reverse=True)


def test_n_best_of_ties_against_all_paths():
    """A vocabulary of equal scores: nearly every path ties with others."""
    pieces = [b"a", b"aa", b"aaa", b"b", b"ab", b" ", b" a"] + [bytes([k]) for k in range(256)]
    v = sentencepieces.Vocabulary(pieces, np.full(len(pieces), -1.0), np.arange(7, 263), -9.0)
    for text in (b" aaaaaa", b" abaab", b" b", b"aab c"):
        brute = every_path(v, text)
        for n in (1, 3, 8):
            found = sentencepieces.n_best(v, text, n)
            assert [s for s, _ in found] == [s for s, _ in brute[:n]]
            assert len({tuple(ids) for _, ids in found}) == len(found)


def test_changes_differ_from_the_best(vocabulary):
    """Of tied paths the best one comes once, whatever the search finds first."""
    for text in ("aaaa aaaa", "." * 300, "abababab " * 3):
        chunk = next(chunks(pa.array([text])))
        ids, edges, nbest = sentencepieces.encode_chunk(vocabulary, chunk, 4)
        every = [tuple(sentencepieces._changed(ids, c)) for _, _, c in nbest[0]]
        assert len(set(every)) == len(every) and every[0] == tuple(ids.tolist())
        assert all(sentencepieces.decode_ids(vocabulary, x) == text for x in every)


def test_what_a_task_remembers_changes_nothing(vocabulary, monkeypatch):
    """The same result for every chunk, with nothing, all or little remembered."""
    rng = random.Random(3)
    some = ["the", "straße", "zz9", "  x", "\n", "aaaa", "q" * 300, "日本", "", "antidisestablishment"]
    texts = pa.array([" ".join(rng.choice(some) for _ in range(rng.randrange(0, 60))) for _ in range(40)])
    def encode(known):
        return [sentencepieces.encode_chunk(vocabulary, c, 3, known) for c in chunks(texts, 300)]
    alone, together = encode(None), encode(sentencepieces.Known())
    monkeypatch.setattr(sentencepieces.Known, "MOST", 4)
    for other in (together, encode(sentencepieces.Known())):
        for a, b in zip(alone, other, strict=True):
            assert a[0].tolist() == b[0].tolist() and a[1].tolist() == b[1].tolist() and a[2] == b[2]


def test_round_trip(docs_of, vocabulary):
    texts = [None, "", " ", "  a▁b ", "\n\n", "café \U0001f600\u0000 x", "word " * 3000,
             "y" * 30_000, "▁", "<0x41></s>", " lead", "trail "]
    docs = docs_of([(k, t, "s") for k, t in enumerate(texts)])
    found = sentencepieces.encoded(docs, n=3, full=True)
    rows = sentencepieces.decoded(found.select("row.doc_id", "ids", "decoded", "nbest")).collect()
    for r in rows:
        source = texts[r.row.doc_id] or ""
        assert r.text == source and r.row.decoded
        scores = [b.score for b in r.row.nbest]
        assert scores == sorted(scores, reverse=True) and len(scores) >= 1
        for b in r.row.nbest:
            assert len(b.ids) == b.n_pieces
            assert sentencepieces.decode_ids(vocabulary, b.ids) == source
            assert b.score == pytest.approx(scores[0], abs=60)
        assert len({tuple(b.ids) for b in r.row.nbest}) == len(r.row.nbest)


# ---- packing

def test_best_fit_against_a_plain_search():
    rng = random.Random(3)
    sizes = sorted((rng.randrange(1, 101) for _ in range(300)), reverse=True)
    room = []
    for s in sizes:
        fit = [r for r in room if r >= s]
        if fit:
            room[room.index(min(fit))] -= s
        else:
            room.append(100 - s)
    rows = packing.best_fit(sizes, 100)
    assert sorted(100 - sum(sizes[k] for k in r) for r in rows) == sorted(room)
    assert sorted(k for r in rows for k in r) == list(range(300))


def test_packed_rows_hold_every_token(docs_of):
    import tiktoken

    texts = [None, "", "a b", "word " * 900, "x" * 2000, "café", "a b"]
    rows = packing.packed_rows(docs_of([(k % 6, t, "s") for k, t in enumerate(texts)]), row=64).collect()
    with open(packing.RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    model = tiktoken.Encoding("t", pat_str=packing.PATTERN, mergeable_ranks=ranks, special_tokens={})
    pieces = defaultdict(dict)
    for r in rows:
        ids, places = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.positions, "<u2")
        assert len(ids) == len(places) == 64 and r.cu_seqlens[0] == 0
        assert r.cu_seqlens[-1] == r.n_tokens and (ids[r.n_tokens:] == packing.END).all()
        for s, a, b in zip(r.segments, r.cu_seqlens[:-1], r.cu_seqlens[1:], strict=True):
            assert (s.offset, s.size) == (a, b - a) and (places[a:b] == np.arange(b - a)).all()
            pieces[s.id, s.rid][s.piece] = ids[a:b]
    got = defaultdict(int)
    for (i, _), p in pieces.items():
        tokens = np.concatenate([p[k] for k in range(len(p))])
        assert tokens[-1] == packing.END
        got[i, model.decode(tokens[:-1].tolist())] += 1
    assert got == {(k % 6, t or ""): 1 for k, t in enumerate(texts)}
    assert packing.packed_rows(docs_of([])).count() == 0


def test_slices_give_the_ids_of_the_whole(docs_of):
    """Cuts never change ids; a long run of white space goes the other way."""
    import tiktoken

    with open(packing.RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    model = tiktoken.Encoding("t", pat_str=packing.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    some = ["a", "b c", "é", "1 ", "  ", " ", "\n", "\xa0", "!", "'s", "don't ", "日本 ", "_x", "\x85",
            "x_ y", " 's", "² 3", "a ́b", "<|endoftext|>"]
    for _ in range(200):
        text = "".join(rng.choice(some) for _ in range(rng.randrange(0, 300)))
        whole = model.encode(text, disallowed_special=())
        for size in (1, 5, 50):
            parts = list(packing.cut(text, size))
            assert "".join(parts) == text
            assert [x for s in parts for x in model.encode(s, disallowed_special=())] == whole
    with open(packing.EXACT, encoding="utf-8") as f:
        content = f.read()
    blank = "x <|endoftext|>" + " " * 1_000_000 + "z"
    found = packing._ids(model, blank, content).tolist()
    assert model.decode(found) == blank and found[-1] == model.encode_single_token(b" z")
    # repeated rows, a null identifier, a text over a slice without a place to cut
    texts = [(1, "a b"), (1, "a b"), (None, "c d"), (2, "x" * 300_000)]
    rows = packing.packed_rows(docs_of([(i, t, "s") for i, t in texts]), row=64).collect()
    held = defaultdict(int)
    for r in rows:
        for s in r.segments:
            held[s.id, s.piece] += s.size
    assert held[1, 0] == 6 and held[None, 0] == 3
    assert sum(n for (i, _), n in held.items() if i == 2) == len(model.encode("x" * 300_000)) + 1


# ---- archives

def test_archive_frames_are_independent():
    records = [warc.record(k, f"http://e/{k}\n", b"<p>" + bytes([65 + k % 20]) * k, "D", k, None)
               for k in range(200)]
    out = io.BytesIO()
    assert warc.archive(records[:50], iter(records[50:]), out)[0] == 200
    assert list(warc.read_archive(io.BytesIO(out.getvalue()))) == records
    with pytest.raises(ValueError):
        list(warc.read_archive(io.BytesIO(out.getvalue()[:-3])))
    head, payload = warc.parse(records[7])
    assert payload == b"<p>" + b"H" * 7 and head["WARC-Target-URI"] == "http://e/7%0A"


def test_pages_come_back(llm):
    html = [None, "", "<p>é</p>", "<p>é</p>", "a\r\n\r\nb", "", "z" * 100_000, "<p>é</p>"]
    frame = llm.createDataFrame([(9 - k, f"u{k}" if k else None, h) for k, h in enumerate(html)],
                                "page_id long, url string, html string")
    folder = f"{warc.new_folder(llm, 'warc-test')}"
    files = warc.staged(warc.write_archives(frame, folder), "warc-files")
    got = {r.page_id: r for r in warc.read_archives(files, folder).collect()}
    assert len(got) == len(html)
    for k, h in enumerate(html):
        r, data = got[9 - k], (h or "").encode()
        head = min(9 - j for j, x in enumerate(html) if (x or "") == (h or ""))
        assert r.payload_bytes == len(data)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert (r.record_type, r.refers_to) == (
            ("response", None) if head == 9 - k else ("revisit", head))
        assert r.payload is None or bytes(r.payload) == data
    empty = warc.new_folder(llm, "warc-test")
    none = warc.staged(warc.write_archives(frame.limit(0), empty), "warc-files")
    assert warc.read_archives(none, empty).count() == 0


def test_pages_of_null_and_repeated_identifiers(llm):
    """Each row comes back: nulls, repeats of the smallest identifier, a very long page, and
    columns whose names the operator uses."""
    long = "<p>" + "x" * 3_000_000
    rows = [(None, "u", "a"), (3, "u", "a"), (3, "v", "a"), (5, "u", "a"), (None, None, "alone"),
            (None, "w", "alone"), (7, "u", long), (6, None, long), (2, "u", ""), (1, "u", None)]
    frame = llm.createDataFrame([(*r, "d", 1) for r in rows],
                                "page_id long, url string, html string, digest string, size int")
    folder = warc.new_folder(llm, "warc-test")
    files = warc.staged(warc.write_archives(frame, folder), "warc-files")
    got = Counter((r.page_id, r.url, r.payload_bytes, r.record_type, r.refers_to)
                  for r in warc.read_archives(files, folder).collect())
    heads = {}
    for i, _, h in rows:
        if i is not None:
            heads[h or ""] = min(i, heads.get(h or "", i))
    want = Counter()
    for i, u, h in rows:
        head = heads.get(h or "")
        kind = ("response", None) if i == head else ("revisit", head)
        want[i, u, len((h or "").encode()), *kind] += 1
    assert got == want


def test_archives_are_read_in_several_tasks(llm):
    """However short the list of archives is, no task reads all of them."""
    folder = warc.new_folder(llm, "warc-test")
    fs, path = pafs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    html = [f"<p>{k}</p>".encode() * (k % 7) for k in range(60)]
    digest = [base64.b32encode(hashlib.sha1(h).digest()).decode() for h in html]
    for nth in range(6):
        records = [warc.record(k, None, html[k], digest[k], len(html[k]), None)
                   for k in range(nth, 60, 6)]
        with fs.open_output_stream(f"{path}/part-{nth}.warc.zst", compression=None) as out:
            assert warc.archive(records[:4], iter(records[4:]), out)[0] == 10
    files = warc.staged(llm.createDataFrame([(f"part-{k}.warc.zst",) for k in range(6)],
                                            "file string"), "warc-files")
    read = warc.read_archives(files, folder).withColumn("task", F.spark_partition_id()).collect()
    assert {r.page_id: bytes(r.payload) for r in read} == dict(enumerate(html))
    assert len(read) == 60 and len({r.task for r in read}) > 1


def test_rows_of_a_batch_are_made_a_few_at_a_time():
    batch = pa.RecordBatch.from_pylist([{"k": k, "t": "x" * k} for k in range(200)])
    made = []

    class Counted:
        num_rows = batch.num_rows

        def slice(self, start, rows):
            made.append(rows)
            return batch.slice(start, rows)

    assert list(warc.rows_of(iter([Counted(), batch.slice(0, 0), batch.slice(7, 1)]))) == [
        *batch.to_pylist(), {"k": 7, "t": "x" * 7}]
    assert max(made) <= warc.ROWS_AT_ONCE < 200


# ---- neighbours

def test_walk_is_in_order_of_summed_score():
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=6), rng.normal(size=5)
    held = rng.integers(0, 3, 30)
    got = multi_index.walk(a, b, held, 10_000)
    want = sorted((c for c in range(30) if held[c]), key=lambda c: -(a[c // 5] + b[c % 5]))
    assert got == want


def test_neighbours_with_copies_and_odd_vectors(llm):
    rng = np.random.default_rng(6)
    rows = [(k, rng.normal(size=8).round(3).tolist(), 0) for k in range(300)]
    rows += [(1000 + k, rows[0][1], 0) for k in range(100)]  # a hot vector
    rows += [(2000, None, 0), (2020, [0.0] * 8, 0), (2040, [1.0, None] * 4, 0),
             (2060, [float("nan")] * 8, 0), (2080, [1.0] * 3, 0)]
    frame = llm.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = defaultdict(list)
    for r in multi_index.neighbours(frame, frame.filter("vec_id % 20 = 0"), probe=10_000).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    good = rows[:400]
    assert set(got) == {i for i, _, _ in good if i % 20 == 0}
    for q in got:
        v = np.array(dict((i, e) for i, e, _ in good)[q])
        want = sorted((-float((np.array(e) * v).sum()), i) for i, e, _ in good if i != q)[:20]
        assert [(n, i) for n, i, _ in sorted(got[q])] == [(n + 1, i) for n, (_, i) in enumerate(want)]
    assert multi_index.neighbours(frame.limit(0), frame).count() == 0


def test_neighbours_of_repeated_identifiers(llm):
    """Many rows of one identifier and vector; a query row that is there twice."""
    rng = np.random.default_rng(8)
    hot, other = [1.0] * 8, (-np.ones(8)).tolist()
    rows = [(20, hot)] * 25 + [(k, hot) for k in range(21, 41)] + [(60, other)] * 2
    rows += [(100 + k, rng.normal(size=8).round(3).tolist()) for k in range(60)]
    frame = llm.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = multi_index.neighbours(frame, frame.filter("vec_id in (20, 21, 60)"), probe=10_000)
    want = Counter()
    for q, v in rows:
        if q in (20, 21, 60):
            near = sorted((-float((np.array(e) * v).sum()), i) for i, e in rows if i != q)[:20]
            want.update((q, n + 1, i) for n, (_, i) in enumerate(near))
    assert Counter((r.query_id, r.rank, r.vec_id) for r in got.collect()) == want


def test_walk_is_long_enough_for_the_recall(llm, monkeypatch):
    """Vectors without structure, most of which a short walk would not see; queries in parts."""
    monkeypatch.setattr(multi_index, "LEAST_PROBE", 40)
    monkeypatch.setattr(multi_index, "TASK_QUERIES", 30)
    rng = np.random.default_rng(7)
    m = rng.normal(size=(2000, 16))
    frame = llm.createDataFrame([(k, v.tolist()) for k, v in enumerate(m)],
                                "vec_id long, embedding array<double>")
    got = defaultdict(dict)
    for r in multi_index.neighbours(frame, frame.filter("vec_id % 20 = 0")).collect():
        got[r.query_id][r.rank] = r.vec_id
        assert r.score == pytest.approx(m[r.query_id] @ m[r.vec_id])
    assert len(got) == 100 and all(sorted(g) == list(range(1, 21)) for g in got.values())
    found = []
    for q, g in got.items():
        s = m @ m[q]
        s[q] = -np.inf
        found.append(len(set(g.values()) & set(np.argsort(-s)[:20].tolist())) / 20)
    assert np.mean(found) >= 0.9


def test_recall(llm):
    frame = llm.read.parquet(f"{SF001}/embeddings.parquet")
    got = defaultdict(set)
    for r in multi_index.op6_multi_index(llm, SF001).collect():
        got[r.query_id].add(r.vec_id)
    rows = frame.collect()
    ids, m = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    found = []
    for q in got:
        s = m @ m[ids == q][0]
        s[ids == q] = -np.inf
        found.append(len(got[q] & set(ids[np.lexsort((ids, -s))[:20]].tolist())) / 20)
    assert np.mean(found) >= 0.9


# ---- registered queries

def test_queries_match_their_sql(llm):
    import duckdb

    from accounthealth.llm.queries import QUERIES, SQL

    con = duckdb.connect()
    for name in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF0001}/{name}.parquet'")
    for key, sql in SQL.items():
        frame = QUERIES[key](llm, SF0001)
        names = sorted(frame.columns)
        got = sorted(tuple(r[c] for c in names) for r in frame.collect())
        result = con.execute(sql)
        own = [d[0] for d in result.description]
        want = sorted(tuple(r[own.index(c)] for c in names) for r in result.fetchall())
        assert sorted(own) == names and got == want, key


def test_pipeline_runs_every_stage(llm):
    import corpus_pipeline

    docs = llm.read.parquet(f"{SF0001}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = frames.staged(stage(llm, before, SF0001), name)
        if name != "sentencepiece":
            assert docs.columns == before.columns
        texts = before.count(), docs.count()
        assert texts[1] <= 2 * texts[0] and texts[1] > 0
    assert docs.filter("not round_trip").count() == 0
