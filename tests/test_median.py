"""Exact grouped median against pandas on a small fixture (brute force)."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from accounthealth.functions import median


def _fixture():
    rnd = random.Random(11)
    rows = []
    for i in range(3000):                      # a hot group: a third of all rows
        rows.append(("hot", rnd.choice([1.0, 1.0, 1.5, 2.0, 0.25]) + rnd.randint(0, 3)))
    for g, n in (("odd", 7), ("even", 8), ("one", 1), ("same", 5)):
        for i in range(n):
            rows.append((g, 3.0 if g == "same" else rnd.uniform(-5, 5)))
    for i in range(6):
        rows.append((None, float(i)))           # the null group is a group
    rows += [("odd", None), ("nulls_only", None), ("even", float("nan"))]
    for i in range(6000):                      # a wide group: many distinct values
        rows.append(("wide", rnd.random() ** 3 * 1000))
    return rows


def _same_as_pandas(spark, rows):
    df = spark.createDataFrame(rows, "seg string, x double")
    got = {r["seg"]: r["m"] for r in median.grouped_median(df, "seg", "x", "m").collect()}
    want = pd.DataFrame(rows, columns=["seg", "x"]).dropna(subset=["x"]) \
        .groupby("seg", dropna=False)["x"].median().to_dict()
    want = {(None if isinstance(k, float) else k): v for k, v in want.items()}
    assert got == want


@pytest.mark.parametrize("bits", [(22, 21, 21), (16, 16, 16, 16), (3, 61)])
def test_grouped_median_matches_pandas(spark, monkeypatch, bits):
    monkeypatch.setattr(median, "DIGIT_BITS", bits)
    _same_as_pandas(spark, _fixture())


def test_digits_sort_like_the_values(spark):
    rnd = random.Random(5)
    values = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 1e308, -1e308, float("inf"), float("-inf")]
    values += [rnd.choice((-1, 1)) * rnd.random() * 10.0 ** rnd.randint(-300, 300) for _ in range(500)]
    df = spark.createDataFrame([(v + 0.0,) for v in values], "x double")
    rows = df.select("x", *[d.alias(f"d{k}") for k, d in enumerate(median.digits(F.col("x")))]).collect()
    assert [r.x for r in sorted(rows, key=lambda r: tuple(r)[1:])] == sorted(v + 0.0 for v in values)
    for r in rows:
        assert all(0 <= d < 1 << b for d, b in zip(tuple(r)[1:], median.DIGIT_BITS, strict=True))


def test_values_crowded_beside_an_outlier(spark):
    """Equal-width ranges would hold all but one value in one range; the digits tell them apart."""
    rows = [("a", 1.0 + k * 2.0 ** -40) for k in range(4000)] + [("a", 1e300), ("a", -1e300)]
    rows += [("b", float(k % 3)) for k in range(1000)] + [("b", 1e18)]
    _same_as_pandas(spark, rows)
    df = spark.createDataFrame(rows, "seg string, x double").filter("seg = 'a'")
    digits = [d.alias(f"d{k}") for k, d in enumerate(median.digits(F.col("x")))]
    alike = [df.select(*digits).groupBy(*keys).count().agg(F.max("count")).first()[0]
             for keys in (["d0"], ["d0", "d1"], ["d0", "d1", "d2"])]
    assert alike[0] == 4000 and alike[1] == 512 and alike[2] == 1
