"""The operators on documents against brute force: awkward rows, ties, copies."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from accounthealth.llm import exact_dedup, frames, mixing, ngram_join, sharding, substring_fm

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def awkward(seed):
    """Copies, near copies, shared passages, periodic text, blanks, nulls, long words."""
    rng = random.Random(seed)
    some = [f"w{k}" for k in range(400)] + ["É", "ß", "a" * 3000]
    passage = [rng.choice(some) for _ in range(50)]
    rows, base = [], [rng.choice(some) for _ in range(90)]
    for k in range(60):
        text = [rng.choice(some) for _ in range(rng.choice([0, 1, 3, 4, 5, 6, 34, 35, 36, 120]))]
        if k % 4 == 0:
            text = text[:20] + passage + text[20:]
        if k % 3 == 0:
            text = [w if rng.random() > 0.02 else rng.choice(some) for w in base]
        rows.append((k, rng.choice([" ", "\n", "  \t"]).join(text), f"src{k % 5}"))
    rows += [(60, None, None), (61, "", "src1"), (62, " \n ", "src1"), (63, "x " * 200, "src2"),
             (64, "p q r " * 60, None), (65, rows[3][1], "src3"), (66, rows[3][1], "src3"),
             (67, "A b C d E", "src0"), (68, "a B c D e", "src0"), (69, rows[1][1], "src0")]
    return rows + [rows[-1], (7, "another text of a repeated identifier", "src0")]


@pytest.mark.parametrize("keep", ["max", "min"])
def test_content_groups(docs_of, keep):
    rows = awkward(1)
    got = exact_dedup.content_groups(docs_of(rows), keep=keep, hot_share=10, salts=3).collect()
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[t or ""].append(i)
    best = max if keep == "max" else min
    want = Counter((i, best(groups[t or ""]), len(groups[t or ""]),
                    hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _ in rows)
    assert Counter((r.id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want


def test_unique_documents_keep_columns_and_nulls(docs_of):
    rows = awkward(2)
    docs = docs_of(rows)
    got = exact_dedup.unique_documents(docs)
    assert got.columns == docs.columns
    kept = got.collect()
    assert len(kept) == len({t or "" for _, t, _ in rows})
    assert {r.row for r in kept} == {"x"}
    by_text = {r.text: r.doc_id for r in kept}
    assert by_text[rows[3][1]] == 66


def test_exact_dedup_of_empty_table_and_null_ids(docs_of, llm):
    assert exact_dedup.unique_documents(docs_of([])).count() == 0
    frame = llm.createDataFrame([(None, "a"), (1, "a"), (None, "b")], "doc_id long, text string")
    got = {(r.id, r.keep_id, r.group_size) for r in exact_dedup.content_groups(frame).collect()}
    assert got == {(None, 1, 2), (1, 1, 2), (None, None, 1)}


def jaccard_components(rows, size=5, percent=75):
    folded = [[re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words(t)] for _, t, _ in rows]
    sets = [frozenset(tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))) if w
            else frozenset() for w in folded]
    group = list(range(len(rows)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                group[root(a)] = root(b)
    least = defaultdict(lambda: 1 << 60)
    for k, (i, _, _) in enumerate(rows):
        least[root(k)] = min(least[root(k)], i)
    return Counter((i, len(s), least[root(k)] if s else i)
                   for k, ((i, _, _), s) in enumerate(zip(rows, sets, strict=True)))


@pytest.mark.parametrize("long_list,shard", [(32, 2_000_000), (2, 300)])
def test_ngram_join(docs_of, monkeypatch, long_list, shard):
    """Also with nearly every list long, and blocks cut into many shards."""
    monkeypatch.setattr(ngram_join, "LONG_LIST", long_list)
    monkeypatch.setattr(ngram_join, "SHARD_SHINGLES", shard)
    rows = awkward(3)
    got = ngram_join.linked(docs_of(rows)).collect()
    assert Counter(tuple(r) for r in got) == jaccard_components(rows)


def shingle_sets(rows, size=5):
    folded = [[re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words(t)] for _, t, _ in rows]
    return [frozenset(tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))) if w
            else frozenset() for w in folded]


def near(a, b, percent=75):
    both = len(a & b)
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


@pytest.mark.parametrize("long_list,shard,most", [(32, 2_000_000, 4000), (2, 300, 3)])
def test_ngram_join_finds_every_link(docs_of, monkeypatch, long_list, shard, most):
    """A dense group of near copies with copies of its own: all its links, not n - 1."""
    monkeypatch.setattr(ngram_join, "LONG_LIST", long_list)
    monkeypatch.setattr(ngram_join, "SHARD_SHINGLES", shard)
    monkeypatch.setattr(ngram_join, "SHARD_SETS", most)
    base = [f"b{k}" for k in range(80)]
    rows = awkward(13) + [(100 + k, " ".join(base[:40] + [f"x{k % 9}"] + base[40:]), "src0")
                          for k in range(14)]
    sets = shingle_sets(rows)
    got = ngram_join.linked(docs_of(rows), links=True).collect()
    want = Counter((i, len(s), sum(near(s, t) for t in sets) - bool(s))
                   for (i, _, _), s in zip(rows, sets, strict=True))
    assert Counter((r.id, r.n_shingles, r.n_links) for r in got) == want
    assert Counter((r.id, r.n_shingles, r.component_id) for r in got) == jaccard_components(rows)

    members, pairs = ngram_join.class_links(docs_of(rows))
    size = Counter(r.class_id for r in members.collect() if r.class_id is not None)
    pairs = [tuple(r) for r in pairs.collect()]
    assert len(size) == len(set(sets) - {frozenset()})
    unlike = list(set(sets))
    assert len(pairs) == len(set(pairs)) == sum(
        near(a, b) for k, a in enumerate(unlike) for b in unlike[:k])
    assert sum(2 * size[a] * size[b] for a, b in pairs) + sum(
        v * (v - 1) for v in size.values()) == sum(n * c for (_, _, n), c in want.items())


def test_search_spans_brute_force_components():
    import numpy as np

    rng = random.Random(4)
    sets, keys = [], []
    for k in range(80):
        if k % 2 and sets:
            old = list(rng.choice(sets))
            new = {x for x in old if rng.random() > 0.1} | {rng.randrange(300) for _ in range(2)}
        else:
            new = {rng.randrange(300) for _ in range(rng.randrange(1, 40))}
        sets.append(np.array(sorted(new), np.uint64))
        keys.append(1000 + k)
    every = np.ones(len(sets), bool)
    links = ngram_join.search(keys, sets, every, every, 75)
    true = {(a, b) for a in range(80) for b in range(a)
            if 100 * (n := len(np.intersect1d(sets[a], sets[b])))
            >= 75 * (len(sets[a]) + len(sets[b]) - n)}
    for a, b in links:
        assert (max(a, b) - 1000, min(a, b) - 1000) in true

    def parts(pairs):
        group = {k: k for k in range(80)}
        for a, b in pairs:
            a, b = group[a], group[b]
            group = {k: b if v == a else v for k, v in group.items()}
        found = defaultdict(set)
        for k, v in group.items():
            found[v].add(k)
        return sorted(map(sorted, found.values()))

    assert parts([(a - 1000, b - 1000) for a, b in links]) == parts(true)


def test_group_heads(docs_of):
    rows = awkward(5)
    docs = docs_of(rows)
    got = ngram_join.group_heads(docs)
    assert got.columns == docs.columns
    heads = {c for _, _, c in jaccard_components(rows)}
    assert {r.doc_id for r in got.collect()} == heads
    assert ngram_join.group_heads(docs_of([])).count() == 0


def null_and_repeated_ids():
    """Near copies that share the smallest identifier, or have none, and a bridge without one."""
    base = [f"g{k}" for k in range(80)]

    def text(at, new, words=base):
        return " ".join(words[:at] + [new] + words[at + 1:])

    other, chain = ([f"{c}{k}" for k in range(80)] for c in "hc")
    moved = [chain]
    for k in range(2):  # each near the one before only
        moved.append([f"m{k}" if n % 40 == 10 + 20 * k else w for n, w in enumerate(moved[-1])])
    return awkward(14) + [
        (200, text(10, "x"), "s"), (200, text(40, "y"), "s"), (201, text(60, "z"), "s"),
        (None, text(20, "n"), "s"), (None, text(5, "p", other), "s"),
        (None, text(70, "q", other), "s"), (None, "a text that nobody repeats at all", "s"),
        (None, None, "s"), (None, " ", "s"), (202, " ".join(moved[0]), "s"),
        (None, " ".join(moved[1]), "s"), (203, " ".join(moved[2]), "s")]


def groups_of(rows):
    """Lists of row numbers that are joined by links; rows without shingles alone."""
    sets = shingle_sets(rows)
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if near(sets[a], sets[b]):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    out = defaultdict(list)
    for k, g in enumerate(group):
        out[g].append(k)
    return list(out.values())


def test_group_heads_of_null_and_repeated_ids(docs_of):
    """Rows, not identifiers: one stays of each group."""
    rows = null_and_repeated_ids()
    got = [(r.doc_id, r.text, r.source) for r in ngram_join.group_heads(docs_of(rows)).collect()]
    groups = groups_of(rows)
    assert len(got) == len(groups)
    left = Counter(got)
    for group in groups:
        ids = [rows[k][0] for k in group if rows[k][0] is not None]
        heads = {rows[k] for k in group if rows[k][0] == (min(ids) if ids else None)}
        head = [h for h in heads if left[h]]
        assert len(head) == 1 and not any(left[rows[k]] for k in group if rows[k] not in heads)
    sets = shingle_sets(rows)
    links = ngram_join.linked(docs_of(rows), links=True).collect()
    assert Counter((r.id, r.n_shingles, r.n_links) for r in links) == Counter(
        (i, len(s), sum(near(s, t) for t in sets) - bool(s))
        for (i, _, _), s in zip(rows, sets, strict=True))


def test_pipeline_stages_of_null_and_repeated_ids(docs_of, llm):
    """Exact and near copies dropped one after the other, as the pipeline does."""
    import corpus_pipeline

    rows, stages = null_and_repeated_ids(), dict(corpus_pipeline.STAGES)
    docs = frames.staged(stages["exact_dedup"](llm, docs_of(rows), ""), "exact")
    kept = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    assert Counter(t or "" for _, t, _ in kept) == Counter({t or "" for _, t, _ in rows})
    got = [(r.doc_id, r.text, r.source) for r in stages["ngram_join"](llm, docs, "").collect()]
    groups = groups_of(kept)
    assert len(got) == len(groups) and not Counter(got) - Counter(kept)
    for group in groups:
        ids = [kept[k][0] for k in group if kept[k][0] is not None]
        heads = {kept[k] for k in group if kept[k][0] == (min(ids) if ids else None)}
        assert sum(g in heads for g in got) == 1


def without_repeats(rows, length=35):
    texts = [words(t) for _, t, _ in rows]
    seen = Counter(tuple(w[k:k + length]) for w in texts for k in range(len(w) - length + 1))
    out = Counter()
    for (i, _, _), w in zip(rows, texts, strict=True):
        gone = set()
        for k in range(len(w) - length + 1):
            if seen[tuple(w[k:k + length])] > 1:
                gone |= set(range(k, k + length))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("seed,shard", [(6, 1_500_000), (7, 1_500_000), (7, 200), (7, 0)])
def test_substring_dedup(docs_of, monkeypatch, seed, shard):
    """Also with some and with all minimisers beyond a shard."""
    monkeypatch.setattr(substring_fm, "SHARD_WORDS", shard or 1)
    rows = awkward(seed)
    got = substring_fm.without_repeats(docs_of(rows)).drop("kept_text").collect()
    assert Counter(tuple(r) for r in got) == without_repeats(rows)


def test_substring_dedup_of_few_words(docs_of):
    """Two words only, so that nearly all windows are near repeats."""
    rng = random.Random(8)
    rows = [(k, " ".join(rng.choice("ab") for _ in range(rng.randrange(0, 300))), "s")
            for k in range(12)]
    rows += [(20 + k, "a " * n + "b " + "a " * n, "s") for k, n in enumerate((20, 34, 35, 50))]
    got = substring_fm.without_repeats(docs_of(rows), length=9).drop("kept_text").collect()
    assert Counter(tuple(r) for r in got) == without_repeats(rows, 9)
    assert substring_fm.without_repeats(docs_of([])).count() == 0


def test_fm_index_counts():
    import numpy as np

    rng = np.random.default_rng(9)
    text = np.append(rng.integers(1, 4, 200), 0)
    index = substring_fm.FMIndex(text, 8)
    for _ in range(50):
        at = int(rng.integers(0, 190))
        run = text[at:at + int(rng.integers(1, 8))]
        lo, hi = np.zeros(1, np.int64), np.array([len(text)])
        for symbol in run[::-1]:
            lo, hi = index.extend(np.array([symbol]), lo, hi)
        count = sum((text[k:k + len(run)] == run).all() for k in range(len(text) - len(run) + 1))
        assert hi[0] - lo[0] == count


def test_mix_takes_exactly_the_targets(docs_of):
    rows = awkward(10)
    got = mixing.mix(docs_of(rows)).collect()
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(words(t))
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    capped = set()
    while True:  # share, cap, share the excess again
        spare = 1.5 * sum(size.values()) - sum(2 * size[s] for s in capped)
        level = spare / sum(weight[s] for s in size if s not in capped)
        more = {s for s in size if s not in capped and level * weight[s] > 2 * size[s] + 1e-9}
        if not more:
            break
        capped |= more
    target = {s: 2 * size[s] if s in capped else level * weight[s] for s in size}
    taken = defaultdict(int)
    for r in got:
        s = next(s for s in size if size[s] == r.source_size and abs(target[s] - r.target) < 1e-6)
        taken[s] += r.taken
        assert 0 <= r.taken <= 2 * r.size
    assert {s: taken[s] for s in size} == {s: int(target[s] + 1e-9) for s in size}


def test_mixed_documents(docs_of):
    docs = docs_of(awkward(11))
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, mixing.mixed_documents(docs).collect()))
    assert mixing.mixed_documents(docs_of([])).count() == 0
    assert mixing.mix(docs_of([(1, None, None), (2, "", "a")])).filter("taken > 0").count() == 0


def test_lookup_table_shares_slots_evenly():
    owners = Counter(sharding.lookup_table(("a", "b", "c"), 101))
    assert max(owners.values()) - min(owners.values()) <= 1
    before = sharding.lookup_table(tuple(f"s{k}" for k in range(10)), 1009)
    after = sharding.lookup_table(tuple(f"s{k}" for k in range(9)), 1009)
    moved = sum(a != b for a, b in zip(before, after, strict=True) if a != "s9")
    assert moved < 0.2 * 1009  # few slots move when a shard leaves
    with pytest.raises(ValueError):
        sharding.lookup_table(("a",), 100)


def test_placement(docs_of, tmp_path):
    rows = awkward(12)
    placed = sharding.place(docs_of(rows)).collect()
    table = sharding.lookup_table()
    assert len(placed) == len(rows)
    assert all(table[r.slot] == r.shard for r in placed)
    docs = docs_of(rows)
    sharding.write_shards(docs, f"{tmp_path}/shards")
    back = docs.sparkSession.read.parquet(f"{tmp_path}/shards")
    assert back.count() == len(rows) and set(docs.columns) < set(back.columns)
    assert sharding.place(docs_of([])).count() == 0


def test_rows_without_identifier_are_mixed_and_placed(docs_of):
    """Null identifiers are rows like others: counted, taken, and in one shard."""
    rows = awkward(16) + [(None, "a b c", "src0"), (None, "a b c", "src0"), (None, "d " * 40, "src1"),
                          (None, None, None), (None, "", "src1")]
    docs = docs_of(rows)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    assert Counter((r.id, r.size) for r in got) == Counter((i, len(words(t))) for i, t, _ in rows)
    size, taken, target = Counter(), Counter(), {}
    for r in got:
        taken[r.source_size, r.target] += r.taken
        target[r.source_size, r.target] = int(r.target + 1e-9)
    for _, t, s in rows:
        size[s] += len(words(t))
    if len(set(size.values())) == len(size):  # sources told apart by their sizes
        assert taken == Counter(target)
    placed = sharding.place(docs).collect()
    assert Counter(r.key for r in placed) == Counter(i for i, _, _ in rows)
    assert len({(r.slot, r.shard) for r in placed if r.key is None}) == 1
