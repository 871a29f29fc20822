"""Physical plan shape: JVM-only operators, per-task top-n, pruned scans."""

from pathlib import Path

import pytest

from accounthealth.plans.registry import all_queries
from accounthealth.plans.warehouse import Warehouse

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                "PythonUDF", "MapInArrow")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        wh = Warehouse.from_testdata(spark, "/root/testdata/sf0.001")
        yield {k: _plan(q.build(wh)) for k, q in all_queries().items()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_no_python_in_any_plan(static_plans):
    for key, plan in static_plans.items():
        assert not any(node in plan for node in PYTHON_NODES), key


def test_top_n_lists_limit_before_shuffle(static_plans):
    for key in ("ws_recent_invoices", "ws_recent_tickets", "ws_recent_events",
                "ws_recent_opportunities", "ws_account_adoption"):
        plan = static_plans[key]
        assert "WindowGroupLimit" in plan and "Partial" in plan, key


def test_global_top_k_is_take_ordered(static_plans):
    for key in ("rpt_top_risk", "rpt_adoption_top", "app_queue_page"):
        assert "TakeOrderedAndProject" in static_plans[key], key


def test_scans_are_pruned(static_plans):
    # health never reads feature variety, so even event_type is pruned
    plan = static_plans["mart_churn_risk"]
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in plan
    assert "props" not in plan and "o_orderdate" not in plan
    contacts = static_plans["src_crm_contacts"]
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:" in contacts


def test_no_cross_join(static_plans):
    for key, plan in static_plans.items():
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, key


def test_summary_joins_reuse_account_partitioning(static_plans):
    # one account-keyed exchange per aggregated side (accounts, subscriptions,
    # revenue, support; usage takes three, each after a map-side partial
    # aggregate), and none between the joins of the summary chain
    plan = static_plans["mart_account_summary"]
    assert plan.count("Exchange hashpartitioning(account_id") <= 7


def test_bucketed_build_removes_report_shuffles(spark, tmp_path):
    from accounthealth.sources.sinks import write_tables

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        wh = Warehouse.from_testdata(spark, "/root/testdata/sf0.001")
        made = {r["table"]: r["path"]
                for r in write_tables(wh, str(tmp_path / "wh"), buckets=8).collect()}
        queries = all_queries()
        for key in ("ws_account_detail", "ws_recent_events", "ws_usage_trend"):
            plan = _plan(queries[key].build(wh))
            # only the per-segment median aggregate may still shuffle
            assert "Exchange hashpartitioning(account_id" not in plan, key
        assert len(list(Path(made["stg_product_events"]).glob("part-*"))) <= 8
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
