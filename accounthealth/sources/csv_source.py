"""CSV source (S1) with the missing-source guard.

Each source is ``<raw_dir>/<name>.csv`` with a header line. Columns are read
as text with an explicit schema (no inference pass over the data); staging
casts them. The default null marker is the empty field only, so the region
text ``NA`` stays a value. Quotes inside a quoted field are doubled. Quoted
line breaks need ``multi_line``, which reads each file whole in one task; it
is off unless asked for.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from accounthealth.sources.schemas import SOURCE_NAMES, raw_text_schema


def read_source(spark: SparkSession, raw_dir: str, name: str,
                multi_line: bool = False) -> DataFrame:
    path = f"{raw_dir.rstrip('/')}/{name}.csv"
    try:
        return (spark.read.schema(raw_text_schema(name))
                .option("header", True)
                .option("mode", "FAILFAST")
                .option("escape", '"')
                .option("multiLine", multi_line)
                .csv(path))
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            raise FileNotFoundError(f"Missing source file: {path}") from exc
        raise


def load(spark: SparkSession, raw_dir: str, multi_line: bool = False) -> dict[str, DataFrame]:
    return {name: read_source(spark, raw_dir, name, multi_line) for name in SOURCE_NAMES}
