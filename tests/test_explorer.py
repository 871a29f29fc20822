"""Queue exploration: search, filters, sorts, paging, actions, brief."""

from accounthealth.operators import explorer as ex


def test_search_trims_and_lowercases(wh_small):
    rows = ex.explore(wh_small, query="  BUILDING ").collect()
    assert rows and all("building" in r["industry"].lower() for r in rows)
    assert ex.explore(wh_small, query="").count() == 150


def test_filters(wh_small):
    rows = ex.explore(wh_small, risk="high", segment="startup").collect()
    assert rows and all(r["churn_risk_band"] == "high" and r["segment"] == "startup"
                        for r in rows)


def test_sort_modes_are_monotone(wh_small):
    for mode, ((k1, d1), (k2, d2)) in ex.SORT_MODES.items():
        rows = ex.explore(wh_small, sort=mode).collect()
        sign = {"asc": 1, "desc": -1}
        keys = [(sign[d1] * (r[k1] or 0), sign[d2] * (r[k2] or 0)) for r in rows]
        assert keys == sorted(keys), mode


def test_paging(wh_small):
    one, two = ex.page(wh_small, pages=1), ex.page(wh_small, pages=2)
    assert one.count() == 30 and two.count() == 60
    ranks = [r["rank"] for r in two.orderBy("rank").collect()]
    assert ranks == list(range(1, 61))
    full = [r["account_id"] for r in ex.explore(wh_small).collect()][:60]
    assert [r["account_id"] for r in two.orderBy("rank").collect()] == full


def test_next_action_precedence(wh_small):
    for r in ex.viewer_queue(wh_small).collect():
        if r["failed_invoice_amount"] > 0:
            assert r["next_action"] == ex.ACTION_BILLING
        elif r["lifecycle_stage"] == "churned":
            assert r["next_action"] == ex.ACTION_CHURN


def test_brief_layout(wh_small):
    brief = ex.account_brief(wh_small).first()["brief"]
    lines = brief.split("\n")
    assert lines[0] == ex.BRIEF_TITLE and lines[1] == ""
    assert lines[3].startswith("Risk band: ") and lines[3].endswith("/100)")
    assert lines[7] == "RECOMMENDED NEXT ACTION"
    assert lines[-2] == ex.MODEL_NOTE and brief.endswith("\n")


def test_facts_and_flags(wh_small):
    facts = ex.observed_facts(wh_small)
    assert facts.count() == 4 * 150
    flags = ex.heuristic_flags(wh_small).collect()
    assert all(r["label"] in ("Below segment feature variety", "Low composite health", "Monitor")
               for r in flags)


def test_best_adoption_one_row_per_event(wh_small):
    rows = ex.best_adoption(wh_small).collect()
    assert len({r["event_name"] for r in rows}) == len(rows) <= 7


def test_whole_queue_is_ranked(wh_small):
    """Every row has its rank, as one sort of the whole queue gives it."""
    for mode in ex.SORT_MODES:
        ranked = ex.ranked_queue(wh_small, sort=mode).orderBy("rank").collect()
        assert [r["rank"] for r in ranked] == list(range(1, 151))
        assert [r["account_id"] for r in ranked] == [
            r["account_id"] for r in ex.explore(wh_small, sort=mode).collect()]


def test_position_of_ties_and_skew(spark):
    """Half of the rows tie on the first key; no window spans the rows."""
    from pyspark.sql import functions as F

    from accounthealth.functions.position import with_position

    frame = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(
        F.col("id") % 100).alias("a"), (F.col("id") * 7919 % 20_011).alias("b"))
    found = with_position(frame, [F.col("a").desc(), F.col("b").asc()], "place").collect()
    want = sorted(((r.a, r.b) for r in found), key=lambda x: (-x[0], x[1]))
    assert [(r.a, r.b) for r in sorted(found, key=lambda r: r.place)] == want
    assert sorted(r.place for r in found) == list(range(1, 20_001))
    assert with_position(frame.limit(0), [F.col("a")]).count() == 0


def test_indexed_search_is_the_scan(spark, wh_small, tmp_path):
    """The same rows for any query, and only the folders of the query's runs are read."""
    from accounthealth.operators import search_index
    from accounthealth.operators.workspace import queue_base

    queue, path = queue_base(wh_small), f"{tmp_path}/index"
    search_index.write_index(queue, path)
    for query in ("building", "  BUILD ", "asia", "er#0000", "a", "", "zzz no such", "customer#000000012",
                  "ma building", "7 "):
        want = sorted(r.account_id for r in ex.search(queue, query).collect())
        got = search_index.indexed_search(queue, path, query)
        assert sorted(r.account_id for r in got.collect()) == want, query
    found = search_index.candidates(spark, path, "building")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and "PushedFilters: [In(gram" in plan
    assert len({f.split("bucket=")[1].split("/")[0] for f in spark.read.parquet(path).filter(
        "bucket in (1, 2)").inputFiles()}) > 2  # all files are known, the filter prunes them
    assert search_index.candidates(spark, path, "ab") is None


def test_index_of_odd_texts(spark, tmp_path):
    from accounthealth.operators import search_index

    rows = [(1, "Ünïcode Ltd", None, None), (2, None, None, "ΑΣΙΑ"), (3, "", "", ""), (4, "ab", "x", "y"),
            (5, "aaaa", "aaaa", "aaaa")]
    queue = spark.createDataFrame(rows, "account_id long, account_name string, industry string, "
                                        "region string")
    search_index.write_index(queue, f"{tmp_path}/index")
    for query in ("ünï", "aaaaa", "aaaa 5", "code ltd", "1", "4 x y"):
        assert search_index.indexed_search(queue, f"{tmp_path}/index", query).count() == \
            ex.search(queue, query).count(), query
