"""Driver contract and oracle agreement on the smallest tables."""


import duckdb
import pytest

import __spark_entry__ as entry_mod
from accounthealth.plans.registry import all_queries

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "orders", "lineitem", "events"]


def test_entry_flagship(spark):
    df = entry_mod.entry(spark)
    assert df.count() == 150
    assert df.columns == ["account_id", "account_name", "segment", "region", "lifecycle_stage",
                          "plan", "health_score", "churn_risk_score", "churn_risk_band"]


def test_every_query_has_oracle():
    qs, sqls = entry_mod.queries(), entry_mod.oracle_sql()
    # the training-data queries have tests of their own
    assert set(sqls) <= set(qs) and set(all_queries()) <= set(sqls)
    assert len(qs) >= 80


@pytest.fixture
def duck():
    """A connection of its own for each test: a fault cannot reach the next one."""
    with duckdb.connect(config={"threads": 4, "memory_limit": "2GB"}) as con:
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
        yield con


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        vals = []
        for i in order:
            v = r[i]
            if hasattr(v, "isoformat"):
                v = v.isoformat()
            vals.append(v)
        out.append(tuple(vals))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.parametrize("key", sorted(all_queries()))
def test_query_matches_oracle(spark, duck, key):
    df = entry_mod.queries()[key](spark, SF)
    res = duck.execute(entry_mod.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon([tuple(r) for r in df.collect()], df.columns) == _canon(res.fetchall(), ocols)
