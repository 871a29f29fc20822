"""Packed sequences: every id once, full windows, and the greedy search against a plain one."""

import math
import random
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

from accounthealth.llm import retrieval_packing as rp


@pytest.fixture(scope="module")
def exact():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(rp.VOCABULARY)


@pytest.fixture(scope="module")
def tokens():
    with open(rp.VOCABULARY, encoding="utf-8") as source:
        return rp.Tokens(source.read())


def awkward():
    rng = random.Random(2)
    words = [f"{a}{b}" for a in ("run", "Über", "tok", "日本", "x") for b in range(40)]
    rows = [(k, " ".join(rng.choice(words[k % 5 * 30:][:60]) for _ in range(rng.choice([1, 9, 60, 300]))))
            for k in range(90)]
    rows += [(200, None), (201, ""), (202, " \n "), (203, "end <|endoftext|> 's it"),
             (204, "long word " * 2000), (205, "q" * 9000), (206, " " * 3000), (None, "no name"),
             (None, "no name"), (3, rows[3][1]), (3, "another text of one identifier"),
             (207, rows[5][1]), (208, "😀é \x85 " * 30)]
    return rows


@pytest.mark.parametrize("row,shard", [(64, 700), (2048, 1 << 18), (2, 50)])
def test_every_id_in_one_piece(docs_of, exact, row, shard):
    rows = awkward()
    got = rp.packed_pieces(docs_of([(i, t, "s") for i, t in rows]), row=row,
                           shard_tokens=shard).collect()
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length > 0
        docs[r.row, r.id, r.doc_tokens].append((r.start, ids))
        sequences[r.sequence_id].append((r.offset, r.length))
    found = Counter()
    for (_, i, size), parts in docs.items():
        whole = []
        for start, ids in sorted(parts):
            assert start == len(whole)
            whole += ids
        assert len(whole) == size
        found[i, tuple(whole)] += 1
    assert found == Counter(
        (i, (*exact.encode(t or "", add_special_tokens=False).ids, 1)) for i, t in rows)
    for parts in sequences.values():
        total = 0
        for offset, length in sorted(parts):
            assert offset == total
            total += length
        assert total == row or total & (total - 1) == 0 and total < row
    assert rp.packed_pieces(docs_of([])).count() == 0


def test_query_columns(llm, tmp_path, exact):
    rows = awkward()
    llm.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, row int").write.parquet(
        f"{tmp_path}/documents.parquet")
    got = rp.op12_packing(llm, f"file://{tmp_path}").collect()
    assert [c for c in got[0].asDict()][:7] == [
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    by_id = defaultdict(list)
    for i, t in rows:
        by_id[i].append([*exact.encode(t or "", add_special_tokens=False).ids, 1])
    for r in got:
        assert any(r.doc_tokens == len(x) and r.ids_crc32 == crc32(
            np.array(x[r.start:r.start + r.length], "<u4").tobytes()) for x in by_id[r.doc_id])


def test_ids_are_those_of_the_named_library(tokens, exact):
    """Each kind of character beside letters, digits, signs and spaces; long runs."""
    points = [c for c in range(1, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}b 1{chr(c)}2 {chr(c)} !{chr(c)}  {chr(c)}\n" for c in points[k:k + 500])
             for k in range(0, len(points), 500)]
    texts += [" " * 1_000_000, "\n" * 300_000 + "x", "a" * 50_000, "<|endoftext|> <|endoftext|>", ""]
    for text in texts:
        assert tokens.ids(text).tolist() == exact.encode(text, add_special_tokens=False).ids
    assert tokens.exact is not None  # the run of spaces took the other way


def plain_fill(units, held, count, mean, row):
    """The same greedy packing with every score counted anew."""
    bags = [Counter(u[:-1].tolist()) for u in units]

    def score(q, d):
        total = 0.0
        for t in bags[q]:
            if t in bags[d]:
                rare = math.log1p((count - held[t] + 0.5) / (held[t] + 0.5))
                times = bags[d][t]
                total += rare * times * (rp.K1 + 1) / (
                    times + rp.K1 * (1 - rp.B + rp.B * len(units[d]) / mean))
        return total

    unused, rest, out = list(range(len(units))), None, []
    while unused or rest:
        seed, begin = rest or (unused.pop(0), 0)
        window, room, rest = [(seed, begin, len(units[seed]) - begin)], row, None
        room -= len(units[seed]) - begin
        while room and unused:
            best = max(unused, key=lambda d: (round(score(seed, d), 9), -d))
            unused.remove(best)
            size = len(units[best])
            window.append((best, 0, min(size, room)))
            if size > room:
                rest = (best, room)
            room -= min(size, room)
        out.append(window)
    return out


def test_greedy_search_against_a_plain_one():
    rng = np.random.default_rng(4)
    units = [np.append(rng.zipf(1.5, rng.integers(0, 40)).clip(2, 300), 1).astype(np.uint16)
             for _ in range(120)]
    held = np.zeros(1 << 16, np.int64)
    for u in units:
        held[np.unique(u[:-1])] += 1
    mean = float(np.mean([len(u) - 1 for u in units]))
    got = list(rp.fill(units, held, len(units), mean, 64))
    want = plain_fill(units, held, len(units), mean, 64)
    full = [w for w in want if sum(x[2] for x in w) == 64]
    assert got[:len(full)] == full
    last = [w for w in want if sum(x[2] for x in w) < 64]
    assert len(last) <= 1 and got[len(full):] == [p for w in last for p in rp.powers(w)]


def test_best_first_is_a_sort():
    rng = np.random.default_rng(6)
    for n in (0, 1, 5, 200):
        scores = rng.integers(-1, 6, n).astype(float)
        want = [k for k in np.argsort(-scores, kind="stable") if scores[k] >= 0]
        assert list(rp.best_first(scores)) == want


def test_shard_table():
    sizes = {2: 30, 5: 80, 6: 350, 9: 10, 11: 95, 12: 4}
    table = rp.shard_table(sizes, 100)
    held = defaultdict(int)
    for sketch, base, many in table:
        assert many == -(-sizes[sketch] // 100)
        for k in range(many):
            held[base + k] += sizes[sketch] / many
    assert sorted(held) == list(range(len(held))) and max(held.values()) <= 100
