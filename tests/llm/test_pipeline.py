"""The whole pipeline against plain Python, stage after stage, row by row."""

import hashlib
import math
import os
import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from accounthealth.llm import frames, sentencepieces, toxicity
from tests.llm.test_documents_operators import groups_of, null_and_repeated_ids, words
from tests.llm.test_llm_models import insults

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def exact(rows):
    """Of equal texts the row with the largest identifier."""
    best = {}
    for row in rows:
        at = best.get(row[1] or "")
        if at is None or (row[0] is not None and (at[0] is None or row[0] > at[0])):
            best[row[1] or ""] = row
    return list(best.values())


def heads(rows):
    """Of linked rows one with the smallest identifier; which of several is the operator's choice."""
    out = []
    for group in groups_of([(r[0], r[1], r[3]) for r in rows]):
        ids = [rows[k][0] for k in group if rows[k][0] is not None]
        out.append([rows[k] for k in group if rows[k][0] == (min(ids) if ids else None)])
    return out


def mixed(rows):
    """How often each row comes: whole passes, and once more before the cut."""
    size = defaultdict(int)
    for r in rows:
        size[r[3]] += len(words(r[1]))
    order = sorted((s for s in size if s is not None)) + [None] * (None in size)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    capped = set()
    while True:
        spare = 3 * sum(size.values()) - 4 * sum(size[s] for s in capped)
        open_weight = sum(weight[s] for s in size if s not in capped)
        more = {s for s in size if s not in capped and spare * weight[s] > 4 * size[s] * open_weight}
        if not more:
            break
        capped |= more
    out = Counter()
    for s in size:
        budget = 2 * size[s] if s in capped else math.floor(spare * weight[s] / (2 * open_weight))
        key = lambda r: hashlib.md5(f"mix:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:15]
        before = 0
        own = [r for r in rows if r[3] == s]
        for r in sorted(own, key=lambda r: (key(r), r[0] is not None, r[0] or 0, len(words(r[1])))):
            epochs = budget // size[s] if size[s] else 0
            out[r] += epochs + (before < budget - epochs * size[s])
            before += len(words(r[1]))
    return out


def test_run_against_plain_python(llm, tmp_path):
    import corpus_pipeline

    rng = random.Random(12)
    rude = [(1000 + k, text, "en", f"s{k % 4}", 1) for k, (text, _) in enumerate(insults(rng, 90))]
    labels = [(1000 + k, 1, int(k % 3 == 0)) for k in range(90)]
    # one row a text without an identifier: several have one key, in any order
    rest = [(i, t, "en", s, 2) for i, t, s in null_and_repeated_ids() if i is not None]
    rows = rude + rest + [(None, "a text that nobody repeats at all", "en", "s1", 3)]
    docs = llm.createDataFrame(rows, COLUMNS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    llm.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet")

    model = toxicity.fit(llm, llm.read.parquet(f"{tmp_path}/documents.parquet"),
                         llm.read.parquet(f"{tmp_path}/labels.parquet"))
    scores = toxicity.scores(model, pa.array([r[1] for r in rows]))
    clean = [r for r, s in zip(rows, scores, strict=True) if s < toxicity.THRESHOLD]
    assert 0 < len(rows) - len(clean) < 60
    groups = heads(exact(clean))
    before = set(os.listdir(frames.shared_dir(llm).removeprefix("file:")))
    got = corpus_pipeline.run(llm, f"file://{tmp_path}").collect()
    left = set(os.listdir(frames.shared_dir(llm).removeprefix("file:"))) - before
    assert sorted(n.rsplit("-", 1)[0] for n in left) == sorted(
        f"pipeline-{name}" for name, _ in corpus_pipeline.STAGES)  # the rest is removed

    # after the exact dedup only different texts of one identifier leave a choice
    chosen = [g[0] for g in groups if len(g) == 1]
    assert len(chosen) >= len(groups) - 2
    v = sentencepieces.load()
    ids = Counter(r.doc_id for r in got)
    if len(chosen) == len(groups):
        assert ids == Counter(dict(_by_id(mixed(chosen))))
    texts = defaultdict(list)
    for g in groups:
        for r in g:
            texts[r[0]].append(r[1] or "")
    for r in got:
        assert r.round_trip
        assert any(_best(v, t) == pytest.approx(r.scores[0], abs=1e-6) for t in texts[r.doc_id])


def _by_id(times):
    out = Counter()
    for row, n in times.items():
        if n:
            out[row[0]] += n
    return out


_KNOWN = {}


def _best(v, text):
    """Score of the best segmentation of the whole text, by one pass over its lattice."""
    if text not in _KNOWN:
        _KNOWN[text] = sentencepieces.forward(
            sentencepieces.Lattice(v, b" " + text.encode()))[-1] if text else 0.0
    return _KNOWN[text]
