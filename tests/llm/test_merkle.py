"""The manifest against a tree built node by node, with awkward rows and small bands."""

import random
from collections import Counter
from hashlib import sha256
from zlib import crc32

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from accounthealth.llm import merkle

COLUMNS = "doc_id long, source string, lang string, n_chars long, text string, root string"


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf_of(row, more=0):
    doc_id, source, lang, n_chars, text = row[:5]
    values = [doc_id, source, lang, None if n_chars is None else n_chars + more, text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(level, fan=2):
    """All levels over a list of digests, the lowest first."""
    levels = [level]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h("".join(below[k:k + fan])) for k in range(0, len(below), fan)])
    return levels


def path(levels, at, fan=2):
    """(digests left, digests right) for each level below the top."""
    out = []
    for level in levels[:-1]:
        run = at // fan * fan
        out.append(("".join(level[run:at]), "".join(level[at + 1:run + fan])))
        at //= fan
    return out


def expected(rows, fan=2):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for group in order:
        held = sorted(groups[group], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[group] = held, climb([leaf_of(r) for r in held], fan)
    crown = climb([trees[g][1][-1][0] for g in order], fan) if order else []
    out = Counter()
    for nth, group in enumerate(order):
        held, levels = trees[group]
        for at, row in enumerate(held):
            steps = path(levels, at, fan) + path(crown, nth, fan)
            hit = row[0] is not None and crc32(str(row[0]).encode()) % 7 == 0
            now = leaf_of(row, int(hit))
            for left, right in steps:
                now = h(left + now + right)
            out[row[0], levels[0][at], levels[-1][0], crown[-1][0],
                h("".join(a + b for a, b in steps)), now, now == crown[-1][0]] += 1
    return out


def awkward():
    rng = random.Random(3)
    rows = [(k, rng.choice(["s", "", None, "ß"]), rng.choice(["en", "en", "en", "de"]),
             rng.choice([None, 0, k, 1 << 62]), rng.choice(["", None, "é" * k, f"text {k}"]), "x")
            for k in range(75)]
    rows += [(None, "s", "en", 1, "a"), (None, None, None, None, None), (7, "s", "en", 2, "b"),
             (7, "s", "en", 2, "b"), (-5, "s", "Ωm", 9, "alone"), (14, "s", "", 3, "t"),
             (-14, "s", "", 3, "w" * 100_000), (9223372036854775807, "s", "fr", 9223372036854775807, "m")]
    rows = [(*r, "x")[:6] for r in rows] + [(k, "s", "z", 4, "same", "x") for k in [49] * 20]
    rng.shuffle(rows)
    return rows


def manifest_rows(spark, rows, fan, band):
    docs = spark.createDataFrame(rows, COLUMNS)
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    count = F.col("n_chars").cast("decimal(20,0)")
    leaves = merkle.leaves(docs, forged={"n_chars": F.when(hit, count + 1).otherwise(count)})
    found, trees, crown = merkle.manifest(leaves, fan, band)
    left, right = F.col("left"), F.col("right")
    got = found.select("id", "digest", "top", "root", merkle.proof_digest(left, right),
                       merkle.folded(F.col("forged"), left, right).alias("f"))
    got = got.withColumn("ok", F.col("f") == F.col("root"))
    return Counter(tuple(r) for r in got.collect()), trees, crown


@pytest.mark.parametrize("fan,band", [(2, 3), (3, 2)])
def test_manifest(llm, fan, band):
    """Also with bands so low that every tree needs several."""
    rows = awkward()
    got, trees, _ = manifest_rows(llm, rows, fan, band)
    assert got == expected(rows, fan)
    assert any(ok for *_, ok in got) and any(not ok for *_, ok in got)
    for nth, nodes in enumerate(trees):
        for r in nodes.select("level", "lo", "hi", "size").distinct().collect():
            assert nth * band <= r.level <= (nth + 1) * band
            assert r.lo % fan ** r.level == 0 and r.hi == min(r.lo + fan ** r.level, r.size)


def test_manifest_of_small_tables(llm):
    assert manifest_rows(llm, [], 2, 8)[0] == Counter()
    for rows in ([(1, None, None, None, None, None)],
                 [(1, "s", "en", 1, "a", "x"), (2, "s", "fr", 1, "a", "x")]):
        assert manifest_rows(llm, rows, 2, 8)[0] == expected(rows)


def test_query_and_its_sql(llm, tmp_path):
    """The registered query and its SQL, over a table with an extra column."""
    rows = [r for r in awkward() if r[3] is None or r[3] < 1 << 62]  # SQL adds in 64 bits
    llm.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    got = merkle.op11_merkle(llm, f"file://{tmp_path}")
    assert Counter(tuple(r) for r in got.collect()) == expected(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert Counter(con.execute(merkle.OP11_SQL).fetchall()) == expected(rows)


def test_containment_refuses_a_gap():
    lo, hi = np.array([0, 4]), np.array([3, 8])
    assert merkle.containing(lo, hi, np.array([2, 5])).tolist() == [0, 1]
    with pytest.raises(ValueError):
        merkle.containing(lo, hi, np.array([3]))


def test_band_of_a_single_leaf():
    one = pa.table({"tree": ["g"], "size": pa.array([1], pa.int64()),
                    "level": pa.array([0], pa.int32()), "lo": pa.array([0], pa.int64()),
                    "hi": pa.array([1], pa.int64()), "id": pa.array([5], pa.int64()),
                    "digest": ["d"], "forged": pa.nulls(1, pa.string()), "place": [0]})
    assert merkle.build_band(one, 0, 2, 8).num_rows == 1
