"""Column types found from text, before a build.

Every value of a text column is tested against a lattice of types (boolean,
bigint, double, date, timestamp, text): a column has the least type that all
its values parse as, so whole numbers with fractions are double, days with
times timestamp, and anything else mixed is text. One aggregate a source counts
all columns in one pass. Besides the found type the report names, for the type
that staging casts to, how many values would fail the cast and one of them, so
a bad source is known before the build starts.

Missing values (null, empty or blank text) fit any type; a column of missing
values is text.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accounthealth.sources.schemas import COLUMNS, STAGED

# (type, pattern of its text, type to parse as), from the least to the greatest.
LATTICE: list[tuple[str, str, str]] = [
    ("boolean", r"^(?i:true|false)$", "boolean"),
    ("bigint", r"^[+-]?\d{1,19}$", "bigint"),
    ("double", r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$", "double"),
    ("date", r"^\d{4}-\d{2}-\d{2}$", "date"),
    ("timestamp", r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?$", "timestamp_ntz"),
]
TEXT = "text"
# Staging reads these leniently: a value that does not parse becomes null there.
LENIENT = {("billing_subscriptions", "ended_at")}


def _parses(text: Column, pattern: str, kind: str) -> Column:
    return text.rlike(pattern) & text.try_cast(kind).isNotNull()


def _column_report(source: str, column: str) -> list[Column]:
    """The aggregates of one column: rows, missing, a count per type, bad values, one of them."""
    text = F.trim(F.col(column).cast("string"))
    given = F.coalesce(text != "", F.lit(False))
    kind = STAGED[source][column] if column in STAGED.get(source, {}) else T.StringType()
    bad = given & text.try_cast(kind).isNull()
    return [F.count_if(given), F.count_if(~given),
            *[F.count_if(given & _parses(text, pattern, to)) for _, pattern, to in LATTICE],
            F.count_if(bad), F.min(F.when(bad, text))]


def type_report(source: str, raw: DataFrame) -> DataFrame:
    """``source, column, found, expected, values, missing, bad, example`` for every column."""
    columns = [c for c in raw.columns if c in COLUMNS.get(source, raw.columns)]
    counted = raw.agg(*[a.alias(f"a{k}_{n}") for k, c in enumerate(columns)
                        for n, a in enumerate(_column_report(source, c))])
    rows = []
    for k, c in enumerate(columns):
        a = [F.col(f"a{k}_{n}") for n in range(len(LATTICE) + 4)]
        found = F.when(a[0] == 0, TEXT)
        for n, (name, _, _) in enumerate(LATTICE):
            found = found.when(a[2 + n] == a[0], name)
        expected = STAGED[source][c].simpleString() if c in STAGED.get(source, {}) else TEXT
        rows += [F.lit(source), F.lit(c), found.otherwise(TEXT), F.lit(expected), a[0], a[1],
                 a[-2], a[-1]]
    return counted.select(F.stack(F.lit(len(columns)), *rows).alias(
        "source", "column", "found", "expected", "values", "missing", "bad", "example"))


def report(sources: Mapping[str, DataFrame]) -> DataFrame:
    """The type report of all given sources."""
    return reduce(DataFrame.unionByName, [type_report(n, sources[n]) for n in sources])


def failing(found: DataFrame) -> DataFrame:
    """The columns with values that would fail the build."""
    lenient = reduce(lambda a, b: a | b, [
        (F.col("source") == s) & (F.col("column") == c) for s, c in LENIENT])
    return found.filter((F.col("bad") > 0) & ~lenient)
