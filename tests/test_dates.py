"""Lenient dates: what the public reader (to_datetime, errors coerced) makes of each text."""

import pytest
from pyspark.sql import functions as F

from accounthealth.functions.dates import lenient_timestamp

# Fixed: text -> the reader's result as UTC text (None: not a time).
FORMS = {
    "2025-01-02": "2025-01-02 00:00:00", "2025-01-02 03:04": "2025-01-02 03:04:00",
    "2025-01-02T03:04:05": "2025-01-02 03:04:05",
    "2025-01-02 03:04:05.123": "2025-01-02 03:04:05.123000",
    "2025-01-02T03:04:05.123456789": "2025-01-02 03:04:05.123456",
    "2025-01-02T03:04:05Z": "2025-01-02 03:04:05",
    "2025-01-02T03:04:05+02:00": "2025-01-02 01:04:05",
    "2025-01-02 03:04:05+0200": "2025-01-02 01:04:05",
    "2025-01-02 03:04:05 -05:30": "2025-01-02 08:34:05",
    "2025-01-02 03:04:05 UTC": "2025-01-02 03:04:05",
    "2025-01-02T03:04:05 EST": "2025-01-02 03:04:05",
    "2025-01-02T03": "2025-01-02 03:00:00", "2025-01-02 03:04 PM": "2025-01-02 15:04:00",
    "2025-01": "2025-01-01 00:00:00", "2025": "2025-01-01 00:00:00",
    "20250102": "2025-01-02 00:00:00", "20250102T030405": "2025-01-02 03:04:05",
    "20250102030405": "2025-01-02 03:04:05", "2025/01/02": "2025-01-02 00:00:00",
    "2025/1/2": "2025-01-02 00:00:00", "2025-1-2": "2025-01-02 00:00:00",
    "2025.01.02": "2025-01-02 00:00:00", "01/02/2025": "2025-01-02 00:00:00",
    "1/2/2025": "2025-01-02 00:00:00", "01-02-2025": "2025-01-02 00:00:00",
    "01.02.2025": "2025-01-02 00:00:00", "01/02/2025 03:04": "2025-01-02 03:04:00",
    "01/02/2025 03:04:05 PM": "2025-01-02 15:04:05", "1/2/25": "2025-01-02 00:00:00",
    "13/02/2025": "2025-02-13 00:00:00", "31-12-2025": "2025-12-31 00:00:00",
    "25/12/2025 10:00": "2025-12-25 10:00:00", "Jan 2, 2025": "2025-01-02 00:00:00",
    "January 2, 2025": "2025-01-02 00:00:00", "2 Jan 2025": "2025-01-02 00:00:00",
    "02-Jan-2025": "2025-01-02 00:00:00", "2025-Jan-02": "2025-01-02 00:00:00",
    "Jan 2025": "2025-01-01 00:00:00", "JAN 2 2025": "2025-01-02 00:00:00",
    "Sept 2, 2025": "2025-09-02 00:00:00", "2nd Jan 2025": "2025-01-02 00:00:00",
    "January 2 2025 3:04 PM": "2025-01-02 15:04:00",
    "Thu, 02 Jan 2025 03:04:05 GMT": "2025-01-02 03:04:05",
    "Thu Jan  2 03:04:05 2025": "2025-01-02 03:04:05", " 2025-01-02 ": "2025-01-02 00:00:00",
    "bad-date": None, "2025-13-01": None, "2025-02-30": None, "02/30/2025": None,
    "20250230": None, "0000-00-00": None, "99/99/2025": None, "": None, " ": None, "nan": None,
    "2025-01-02 24:00": None, "2025-01-02T03:04:60": None, "1735786800": None,
    "2025-W01-4": None, "2025-002": None, "1677-01-01": None, "9999-12-31": None,
}


def test_forms(spark):
    rows = spark.createDataFrame([(t,) for t in FORMS], "text string")
    got = {r.text: r.t for r in rows.select(
        "text", lenient_timestamp(F.col("text")).cast("string").alias("t")).collect()}
    want = {t: v and (v.rstrip("0").rstrip(".") if "." in v else v) for t, v in FORMS.items()}
    assert got == want


def test_forms_are_those_of_the_reader():
    """The fixed results above, from the reader itself."""
    pd = pytest.importorskip("pandas")
    for text, want in FORMS.items():
        found = pd.to_datetime(pd.Series([text]), errors="coerce", utc=True)[0]
        assert (None if pd.isna(found) else found.floor("us").tz_localize(None)) == (
            None if want is None else pd.Timestamp(want)), text


def test_other_types_and_nulls(spark):
    frame = spark.sql("SELECT date'2025-01-02' AS d, timestamp_ntz'2025-01-02 03:04:05.5' AS t, "
                      "cast(null AS string) AS n")
    row = frame.select(*[lenient_timestamp(F.col(c)).cast("string").alias(c) for c in "dtn"]).first()
    assert tuple(row) == ("2025-01-02 00:00:00", "2025-01-02 03:04:05.5", None)
