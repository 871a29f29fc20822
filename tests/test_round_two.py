"""Rows and values the shared fixture does not hold: quoting, fractions,
non-finite numbers, hot accounts, and plans that stay lazy."""

import csv

import pytest
from pyspark.sql import functions as F

from accounthealth.functions.money import exact_avg, money_sum, score_avg
from accounthealth.functions.text import title_case
from accounthealth.operators import quality, workspace as ws
from accounthealth.plans.registry import all_queries
from accounthealth.plans.warehouse import Warehouse
from accounthealth.sources import bindings, csv_source, sinks
from accounthealth.sources.schemas import SOURCE_NAMES, raw_text_schema
from tests.conftest import SF001, SF0001


def test_averages_are_not_rounded(spark):
    frame = spark.createDataFrame([(1.004, 4e-7), (1.004, 4e-7)], "hours double, score double")
    row = frame.agg(exact_avg("hours").alias("h"), score_avg("score").alias("s"),
                    money_sum("hours").alias("m")).first()
    assert (row.h, row.s, row.m) == (1.004, 4e-7, 2.008)


def test_title_case_keeps_capitals(spark):
    frame = spark.createDataFrame([("SMB",), ("mid_market",), ("",), (None,), ("a__b",)], "x string")
    assert [r.t for r in frame.select(title_case(F.col("x")).alias("t")).collect()] == [
        "SMB", "Mid Market", "—", "—", "A  B"]


def test_csv_quoting(spark, tmp_path):
    names = raw_text_schema("crm_accounts").fieldNames()
    values = [["1", 'Acme "Best", Inc'], ["2", "NA"], ["3", ""]]
    with open(tmp_path / "crm_accounts.csv", "w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(names)
        writer.writerows(v + ["x"] * (len(names) - 2) for v in values)
    rows = csv_source.read_source(spark, str(tmp_path), "crm_accounts").collect()
    assert [r[1] for r in rows] == ['Acme "Best", Inc', "NA", None]


def test_csv_line_breaks_when_asked(spark, tmp_path):
    names = raw_text_schema("crm_accounts").fieldNames()
    with open(tmp_path / "crm_accounts.csv", "w", newline="") as out:
        csv.writer(out).writerows([names, ["1", "two\nlines"] + ["x"] * (len(names) - 2)])
    rows = csv_source.read_source(spark, str(tmp_path), "crm_accounts", multi_line=True).collect()
    assert [r[1] for r in rows] == ["two\nlines"]


def test_every_source_is_read_in_its_column_order(spark, tmp_path):
    for name in SOURCE_NAMES:
        names = raw_text_schema(name).fieldNames()
        with open(tmp_path / f"{name}.csv", "w", newline="") as out:
            csv.writer(out).writerows([names, [f"{name}{k}" for k in range(len(names))]])
    for name, frame in csv_source.load(spark, str(tmp_path)).items():
        assert list(frame.first()) == [f"{name}{k}" for k in range(len(frame.columns))]


def test_queue_export_reads_back(spark, tmp_path):
    export = spark.createDataFrame([(1, 'a "b", c', 2.5), (2, None, 100.0)],
                                   "account_id long, name string, score double")
    sinks.write_queue_csv(export, f"{tmp_path}/out")
    back = (spark.read.option("header", True).option("escape", '"')
            .csv(f"{tmp_path}/out").orderBy("account_id").collect())
    assert [tuple(r) for r in back] == [("1", 'a "b", c', "2.5"), ("2", None, "100")]


def test_json_safe_at_any_depth(spark):
    nan, inf = float("nan"), float("inf")
    frame = spark.createDataFrame(
        [(nan, (1, -inf), [(inf, "a"), (2.0, None)], [[nan, 1.0]], None)],
        "a double, s struct<i:int,d:double>, l array<struct<d:double,t:string>>, "
        "n array<array<double>>, e struct<d:double>")
    row = ws.json_safe(frame).first()
    assert row.a is None and tuple(row.s) == (1, None)
    assert [tuple(r) for r in row.l] == [(None, "a"), (2.0, None)]
    assert row.n == [[None, 1.0]] and row.e is None


def test_sources_use_all_rows(spark):
    def count(name):
        return spark.read.parquet(f"{SF001}/{name}.parquet").count()

    sources = bindings.load(spark, SF001)
    assert sources["crm_opportunities"].count() == count("orders")
    assert sources["marketing_leads"].count() == count("customer")
    lines = spark.read.parquet(f"{SF001}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    assert sources["crm_contacts"].count() == lines.distinct().count()
    tickets = sources["support_tickets"]
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,P)]" in \
        tickets._jdf.queryExecution().executedPlan().toString()


def test_fixture_has_all_bands_and_differing_medians(wh_mid):
    bands = {r[0] for r in wh_mid.table("mart_churn_risk").select("churn_risk_band")
             .distinct().collect()}
    assert bands == {"low", "medium", "high", "already_churned"}
    medians = [r.segment_median_features for r in ws.segment_median(ws.feature_variety(wh_mid)).collect()]
    assert len(set(medians)) > 1


def test_medians_read_the_same_values_as_the_queue(wh_small):
    own = ws.feature_variety(wh_small)
    base = ws.queue_base(wh_small).select(*own.columns)
    assert own.exceptAll(base).count() == base.exceptAll(own).count() == 0


@pytest.mark.parametrize("key", ["ws_queue", "app_next_action", "app_account_brief", "app_queue_page"])
def test_queue_queries_build_without_jobs(spark, key):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"build-{key}", key)
    try:
        all_queries()[key].run(spark, SF0001)
        assert list(tracker.getJobIdsForGroup(f"build-{key}")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_writing_after_reading_uses_the_built_tables(spark, tmp_path):
    wh = Warehouse.from_testdata(spark, SF0001)
    wh.table("mart_churn_risk")
    sinks.write_tables(wh, f"{tmp_path}/wh")
    files = wh.table("scored_accounts").inputFiles()
    assert files and all("/wh/" in f for f in files)


def test_accounts_are_one_scan_with_copies(spark):
    accounts = bindings.load(spark, SF0001)["crm_accounts"]
    plan = accounts._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Relation [" in line and "c_custkey" in line for line in plan.splitlines()) == 1


def test_hot_account_orphans(spark):
    sources = {n: spark.createDataFrame([], raw_text_schema(n)) for n in SOURCE_NAMES}
    sources["billing_invoices"] = spark.createDataFrame(
        [(str(k), "1", "7", "2025-01-01", "1.0", "paid") for k in range(50)]
        + [("90", "1", None, "2025-01-01", "1.0", "paid")],
        raw_text_schema("billing_invoices"))
    row = quality.audit(Warehouse(spark, sources), ["revenue_account_relationship"]).first()
    assert row["observed"] == 51


def test_month_first_dates_count_as_bad_periods(spark):
    names = raw_text_schema("billing_subscriptions").fieldNames()
    sources = {n: spark.createDataFrame([], raw_text_schema(n)) for n in SOURCE_NAMES}
    row = {n: "1" for n in names} | {"started_at": "02/01/2025", "ended_at": "01/02/2025"}
    sources["billing_subscriptions"] = spark.createDataFrame(
        [tuple(row[n] for n in names)], raw_text_schema("billing_subscriptions"))
    found = quality.audit(Warehouse(spark, sources), ["subscription_end_before_start"]).first()
    assert found["observed"] == 1


def test_sorts_differ_in_order(spark):
    ranks = {k: [r.account_id for r in all_queries()[f"app_sort_{k}"].run(spark, SF0001)
                 .orderBy("rank").collect()] for k in ("risk", "revenue", "health", "support")}
    assert ranks["risk"] != ranks["revenue"] != ranks["health"]
