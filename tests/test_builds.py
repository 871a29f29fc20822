"""Published builds: readers never see a half build; the audit of a build scans no source."""

import glob

import pytest

from accounthealth.operators import quality
from accounthealth.plans.warehouse import MODEL_NAMES, Warehouse
from accounthealth.sources import sinks
from accounthealth.sources.schemas import SOURCE_NAMES, raw_text_schema
from tests.conftest import SF0001


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_audit_of_a_build_reads_no_source(spark, tmp_path):
    wh = Warehouse.from_testdata(spark, SF0001)
    before = rows_of(quality.audit(wh))
    counts = {n: wh.table(n).count() for n in MODEL_NAMES}
    manifest = sinks.write_tables(wh, f"{tmp_path}/wh")
    assert {r["table"]: r["rows"] for r in manifest.collect()} == counts
    audit = quality.audit(wh)
    assert rows_of(audit) == before
    files = {f.split("/builds/")[-1].split("/", 1)[-1].split("/")[0] for f in audit.inputFiles()}
    assert files == {"fct_subscription_revenue", "dim_accounts"}
    later = sinks.read_built(spark, f"{tmp_path}/wh", wh.sources)
    assert later.observed == wh.observed and rows_of(quality.audit(later)) == before
    assert rows_of(quality.summary(quality.audit(later))) == rows_of(
        quality.summary(quality.audit(Warehouse.from_testdata(spark, SF0001))))


def test_observed_duplicates_count_null_ids_as_one_value(spark, tmp_path):
    names = raw_text_schema("crm_accounts").fieldNames()
    sources = {n: spark.createDataFrame([], raw_text_schema(n)) for n in SOURCE_NAMES}
    rows = [{"account_id": i, "created_at": "2025-01-01", "lifecycle_stage": s}
            for i, s in (("1", "lead"), ("1", "paused"), (None, None), (None, "trial"), ("2", "lead"))]
    sources["crm_accounts"] = spark.createDataFrame(
        [tuple(r.get(n) for n in names) for r in rows], raw_text_schema("crm_accounts"))
    wh = Warehouse(spark, sources)
    plain = rows_of(quality.audit(wh))
    sinks.write_tables(wh, f"{tmp_path}/wh")
    assert wh.observed["duplicate_crm_accounts"] == 2
    assert wh.observed["accepted_lifecycle_values"] == 2
    assert rows_of(quality.audit(wh)) == plain


def test_a_build_that_dies_leaves_the_former_one(spark, tmp_path):
    root = f"{tmp_path}/wh"
    good = Warehouse.from_testdata(spark, SF0001)
    sinks.write_tables(good, root)
    first = sinks.latest_build(spark, root)
    want = rows_of(good.table("mart_churn_risk"))

    bad = Warehouse.from_testdata(spark, SF0001)
    invoices = bad.raw("billing_invoices").selectExpr(
        "invoice_id", "subscription_id", "account_id", "invoice_date",
        "if(invoice_id % 7 = 0, 'not a number', cast(amount as string)) as amount", "status")
    bad.sources = dict(bad.sources.items()) | {"billing_invoices": invoices}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        sinks.write_tables(bad, root)
    # the accounts of the dead build are there, but nobody is led to them
    assert len(glob.glob(f"{root}/builds/*/stg_crm_accounts")) == 2
    assert sinks.latest_build(spark, root) == first
    assert rows_of(sinks.read_built(spark, root).table("mart_churn_risk")) == want


def test_versions_follow_each_other_and_old_builds_go(spark, tmp_path):
    root = f"{tmp_path}/wh"
    assert sinks.latest_build(spark, root) is None
    with pytest.raises(FileNotFoundError):
        sinks.read_built(spark, root)
    wh = Warehouse.from_testdata(spark, SF0001)
    for version in (1, 2, 3):
        sinks.write_tables(wh, root, ["dim_plans", "dim_date"])
        assert sinks.latest_build(spark, root)[0] == version
    kept = sinks.latest_build(spark, root)[1].rsplit("/", 1)[-1]
    assert len(sinks.remove_old_builds(spark, root, keep=1)) == 2
    assert [p.rsplit("/", 1)[-1] for p in glob.glob(f"{root}/builds/*")] == [kept]


def test_a_source_without_rows_is_observed(spark, tmp_path):
    wh = Warehouse(spark, {n: spark.createDataFrame([], raw_text_schema(n)) for n in SOURCE_NAMES})
    plain = rows_of(quality.audit(wh))
    sinks.write_tables(wh, f"{tmp_path}/wh")
    assert rows_of(quality.audit(wh)) == plain
