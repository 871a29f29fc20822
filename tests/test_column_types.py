"""Column types from text, mixed columns among them."""

import pytest

from accounthealth import jobs
from accounthealth.sources import column_types
from accounthealth.sources.schemas import COLUMNS, SOURCE_NAMES, raw_text_schema


def test_the_least_type_of_mixed_columns(spark):
    columns = {
        "b": (["true", "FALSE", None], "boolean"), "i": (["1", "-20", " 3 "], "bigint"),
        "f": (["1", "2.5", "1e3"], "double"), "d": (["2025-01-02", "", "2024-02-29"], "date"),
        "t": (["2025-01-02", "2025-01-02 03:04:05.25", "2025-01-02T03:04"], "timestamp"),
        "x": (["1", "2025-01-02", "3"], "text"), "none": ([None, "", " "], "text"),
        "bad_day": (["2025-02-30", "2025-01-01", "2025-01-02"], "text"),
        "big": (["99999999999999999999", "1", "2"], "double"), "bit": (["true", "1", "0"], "text"),
        "zip": (["007", "1", "2"], "bigint"), "word": (["NaN", "Infinity", "a"], "text"),
    }
    frame = spark.createDataFrame(list(zip(*[v for v, _ in columns.values()], strict=True)),
                                  ", ".join(f"{c} string" for c in columns))
    got = {r["column"]: r for r in column_types.type_report("a file", frame).collect()}
    assert {c: r.found for c, r in got.items()} == {c: kind for c, (_, kind) in columns.items()}
    assert (got["none"]["values"], got["none"].missing, got["d"].missing) == (0, 3, 1)


def test_values_that_would_fail_the_build_are_named(spark):
    names = COLUMNS["billing_subscriptions"]
    rows = [("1", "1", "starter", "active", "2025-01-01", "bad-date", "900.0"),
            ("x7", "2", "starter", "active", "2025-01-01", None, "9,5"),
            ("x1", "3", "starter", "active", "soon", None, None)]
    frame = spark.createDataFrame(rows, raw_text_schema("billing_subscriptions"))
    found = column_types.type_report("billing_subscriptions", frame)
    got = {r["column"]: (r.bad, r.example) for r in found.collect() if r.bad}
    assert got == {"subscription_id": (2, "x1"), "started_at": (1, "soon"), "mrr": (1, "9,5"),
                   "ended_at": (1, "bad-date")}
    assert {r["column"] for r in column_types.failing(found).collect()} == set(got) - {"ended_at"}
    assert len(names) == found.count()


def test_the_job_stops_before_a_build_that_would_fail(spark, tmp_path):
    for name in SOURCE_NAMES:
        values = {"account_id": "seven"} if name == "crm_accounts" else {}
        line = ",".join(values.get(c, "") for c in COLUMNS[name])
        (tmp_path / f"{name}.csv").write_text(",".join(COLUMNS[name]) + "\n" + line + "\n")
    with pytest.raises(SystemExit, match="crm_accounts.account_id: 1 values are no bigint, as 'seven'"):
        jobs.main(["--csv-dir", str(tmp_path), "--out", f"{tmp_path}/out", "--check-types"])
    assert not (tmp_path / "out").exists()
