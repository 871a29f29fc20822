"""The audit against a walk through every order, document by document."""

import random
import re
from collections import Counter
from itertools import permutations

import duckdb

from accounthealth.llm import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string, part string"
LABELS = "doc_id long, quality int, toxic int"


def fails(row, rows):
    doc_id, text = row[0], row[1] or ""
    words = WORD.findall(text)
    smaller = any(r[0] is not None and doc_id is not None and r[0] < doc_id
                  and (r[1] or "") == text for r in rows)
    tests = [len(words) < 50, 100 * len(set(words)) < 65 * len(words),
             100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
             bool(re.search(r"[#$%&*|]", text)), smaller]
    return {f for f, bad in zip("ABCDE", tests, strict=True) if bad}


def walked(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    parts = {}
    for row in rows:
        parts.setdefault(row[2] or "", []).append((row[0], fails(row, rows)))
    out = Counter()
    for part, docs in parts.items():
        removed = Counter()
        lines = []
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                removed[f] += len(gone)
                lines.append((f, part, order, step, len(left), len(gone),
                              sum(f in d[1] for d in docs) - len(gone),
                              sum(d[1] == {f} for d in docs), sum(d[0] in good for d in gone),
                              sum(d[0] in toxic for d in gone)))
        for f, *line in lines:
            out[(*line, removed[f])] += 1
    return out


def awkward():
    rng = random.Random(5)
    some = [f"w{k}" for k in range(200)]
    rows = []
    for k in range(70):
        words = [rng.choice(some[:rng.choice([10, 40, 200])]) for _ in range(rng.choice([0, 5, 49, 50, 51, 90]))]
        if rng.random() < 0.3:
            words.append(rng.choice(["a#b", "$", "x|y", "fine"]))
        if rng.random() < 0.3:
            words = [w.upper() for w in words]
        rows.append((k, rng.choice([" ", "\n", "\t\x0b"]).join(words), rng.choice(["a", "b", None, ""])))
    rows += [(100 + k, rows[rng.randrange(70)][1], "a") for k in range(20)]
    rows += [(5, rows[3][1], "b"), (5, rows[3][1], "b"), (0, rows[0][1], "c"), (None, rows[0][1], "c"),
             (None, None, None), (200, None, "b"), (201, "", "b"), (202, "\xa0É " * 60, "b"),
             (203, "long " * 100_000, "b"), (-1, "long " * 100_000, "a")]
    return [(*r, "x") for r in rows]


LABEL_ROWS = [(k, k % 2, (k // 2) % 2) for k in range(0, 120, 3)] + [
    (5, 1, None), (5, 0, 1), (None, 1, 1), (100, None, None), (201, 1, 1)]


def test_audit(llm):
    rows = awkward()
    got = filter_audit.audit(filter_audit.mask_counts(
        llm.createDataFrame(rows, DOCS), llm.createDataFrame(LABEL_ROWS, LABELS)))
    assert Counter(tuple(r) for r in got.collect()) == walked(rows, LABEL_ROWS)
    empty = filter_audit.audit(filter_audit.mask_counts(
        llm.createDataFrame([], DOCS), llm.createDataFrame([], LABELS)))
    assert empty.count() == 0


def test_sql_of_awkward_rows(tmp_path, llm):
    rows = awkward()
    llm.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    llm.createDataFrame(LABEL_ROWS, LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.execute(f"CREATE VIEW {table} AS FROM '{tmp_path}/{table}.parquet/*.parquet'")
    assert Counter(con.execute(filter_audit.OP13_SQL).fetchall()) == walked(rows, LABEL_ROWS)


def test_removals_cover_every_order_once():
    """For each mask and order exactly one step removes; other numbers of filters too."""
    for n in (1, 2, 3, 5):
        orders = list(permutations(range(n)))
        assert [filter_audit.lehmer_rank(p, n) for p in orders] == list(range(len(orders)))
        ends = filter_audit.removals(n)
        for mask in range(1, 1 << n):
            for rank, order in enumerate(orders):
                steps = [s for s in range(1, n + 1) if sum(
                    c for m, k, r, c in ends if (m, k) == (mask, s) and r <= rank)]
                assert steps == [1 + next(k for k, f in enumerate(order) if mask >> f & 1)]
