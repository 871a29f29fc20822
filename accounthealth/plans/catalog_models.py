"""Registered queries: sources, staging, dimensions, facts, marts, manifest."""

from __future__ import annotations

from pyspark.sql import functions as F

from accounthealth.plans.registry import register
from accounthealth.plans.warehouse import MODEL_NAMES, Warehouse
from accounthealth.session import scratch_folder
from accounthealth.sources import column_types
from accounthealth.sources.schemas import SOURCE_NAMES, STAGED
from accounthealth.sources.sinks import remove_folder, write_tables

# Raw sources (S1) and every staging/dimension/fact/mart model, one key each.
# dim_plans and dim_date are literal tables: they are covered by
# build_manifest rather than registered alone.


def _source_query(name: str):
    register(f"src_{name}", f"SELECT * FROM {name}")(lambda wh: wh.raw(name))


def _model_query(name: str):
    register(name, f"SELECT * FROM {name}")(lambda wh: wh.table(name))


for _src in SOURCE_NAMES:
    _source_query(_src)

for _model in MODEL_NAMES:
    if _model not in ("dim_plans", "dim_date"):
        _model_query(_model)


@register("mart_segment_adoption", """
SELECT p.segment, p.event_name, p.events, p.adopting_accounts, s.segment_accounts,
       p.adopting_accounts::DOUBLE / nullif(s.segment_accounts, 0) AS segment_adoption_rate
FROM mart_product_adoption p
JOIN (SELECT segment, count(*) AS segment_accounts FROM dim_accounts GROUP BY segment) s
  ON p.segment IS NOT DISTINCT FROM s.segment
""")
def mart_segment_adoption(wh):
    return wh.table("mart_segment_adoption")


def _types_sql() -> str:
    """Each column's values tested one by one, as a long table of texts."""
    parts = []
    for source in SOURCE_NAMES:
        for column, kind in STAGED[source].items():
            parts.append(
                f"SELECT '{source}' AS source, '{column}' AS \"column\", "
                f"'{kind.simpleString()}' AS expected, trim(CAST({column} AS VARCHAR)) AS t, "
                f"TRY_CAST(nullif(trim(CAST({column} AS VARCHAR)), '') AS "
                f"{_DUCK_TYPES[kind.simpleString()]}) IS NULL AS fails FROM {source}")
    texts = " UNION ALL ".join(parts)
    return f"""
, texts AS ({texts}),
kinds AS (
    SELECT source, "column", expected, t, fails,
           CASE WHEN regexp_full_match(t, '(?i)true|false') THEN 'boolean'
                WHEN TRY_CAST(t AS BIGINT) IS NOT NULL AND regexp_full_match(t, '[+-]?[0-9]+')
                    THEN 'bigint'
                WHEN TRY_CAST(t AS DOUBLE) IS NOT NULL AND regexp_matches(t, '^[+-.0-9]')
                    THEN 'double'
                WHEN length(t) = 10 AND TRY_CAST(t AS DATE) IS NOT NULL THEN 'date'
                WHEN TRY_CAST(t AS TIMESTAMP) IS NOT NULL THEN 'timestamp'
                ELSE 'text' END AS kind
    FROM texts WHERE t <> ''
),
held AS (
    SELECT source, "column", list_sort(list(DISTINCT kind)) AS kinds, count(*) AS n,
           count(*) FILTER (fails) AS bad, min(t) FILTER (fails) AS example
    FROM kinds GROUP BY ALL
)
SELECT a.source, a."column",
       CASE WHEN h.n IS NULL THEN 'text' WHEN len(kinds) = 1 THEN kinds[1]
            WHEN kinds = ['bigint', 'double'] THEN 'double'
            WHEN kinds = ['date', 'timestamp'] THEN 'timestamp' ELSE 'text' END AS found,
       a.expected, coalesce(h.n, 0) AS "values", a.n - coalesce(h.n, 0) AS missing,
       coalesce(h.bad, 0) AS bad, h.example
FROM (SELECT source, "column", expected, count(*) AS n FROM texts GROUP BY ALL) a
LEFT JOIN held h ON a.source = h.source AND a."column" = h."column"
"""


_DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE",
               "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@register("src_column_types", _types_sql())
def src_column_types(wh):
    """The type of every source column, found from its text."""
    return column_types.report({name: wh.raw(name) for name in SOURCE_NAMES})


_MANIFEST_SQL = "\nUNION ALL\n".join(
    f"SELECT '{layer}' AS layer, '{name}' AS \"table\", count(*) AS rows FROM {name}"
    for layer, name in sorted(
        [("staging", n) for n in MODEL_NAMES if n.startswith("stg_")]
        + [("dimensions", n) for n in MODEL_NAMES if n.startswith("dim_")]
        + [("facts", n) for n in MODEL_NAMES if n.startswith("fct_")]
        + [("marts", n) for n in MODEL_NAMES if n.startswith("mart_")],
        key=lambda t: t[1])
)


@register("build_manifest", _MANIFEST_SQL)
def build_manifest(wh):
    """Every model built as a table in build order, then listed by name
    with the rows of the written table."""
    folder = scratch_folder(wh.spark)
    manifest = write_tables(Warehouse(wh.spark, wh.sources), folder).select("layer", "table", "rows")
    remove_folder(wh.spark, folder)  # the manifest has been counted by the writes
    return manifest


@register("sink_tables", """
SELECT 'mart_churn_risk' AS "table", count(*) AS rows,
       count(DISTINCT account_id) AS distinct_accounts FROM mart_churn_risk
""")
def sink_tables(wh):
    """S3: a model written as a table and read back (rows and distinct keys)."""
    own, folder = Warehouse(wh.spark, wh.sources), scratch_folder(wh.spark)
    write_tables(own, folder, ["mart_churn_risk"])
    row = own.table("mart_churn_risk").agg(  # bound to the written table
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("account_id").alias("distinct_accounts")).first()
    remove_folder(wh.spark, folder)
    return wh.spark.createDataFrame([("mart_churn_risk", *row)],
                                    "table string, rows long, distinct_accounts long")
