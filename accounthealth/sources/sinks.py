"""Sinks: model tables (S3/S4), audit JSON (S6), account detail JSON lines
(S7) and the queue CSV export (S8).

Every sink is a distributed Spark write (one task per partition); only the
audit document, which has exactly ten check rows, is written as one file.

A build never touches the tables of the one before: it writes to a folder of its
own and is published by one last, small write. Readers follow the latest
published build, so a job that dies midway leaves the former tables in place.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from accounthealth.functions.text import js_string
from accounthealth.operators.quality import BUILT_METRICS, RAW_METRICS, observed_checks
from accounthealth.plans.warehouse import LAYER, MODEL_NAMES, Warehouse

TIMESTAMP_TEXT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"
PUBLISHED = "published"  # one row a published build, in this subfolder
OBSERVED = "observed_checks"  # what the audit needs of a build's sources and models


# --- published builds

def _file_system(spark: SparkSession, path: str):
    """(the file system that holds ``path``, the path) on anything Spark reaches."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def folder_exists(spark: SparkSession, path: str) -> bool:
    files, where = _file_system(spark, path)
    return files.exists(where)


def remove_folder(spark: SparkSession, path: str) -> None:
    files, where = _file_system(spark, path)
    files.delete(where, True)


def published_builds(spark: SparkSession, root: str) -> DataFrame | None:
    """``version, build`` of the published builds under ``root``; None if there are none."""
    if not folder_exists(spark, f"{root}/{PUBLISHED}"):
        return None
    return spark.read.schema("version long, build string").parquet(f"{root}/{PUBLISHED}")


def latest_build(spark: SparkSession, root: str) -> tuple[int, str] | None:
    """(version, folder) of the build that readers should use."""
    found = published_builds(spark, root.rstrip("/"))
    row = found and found.orderBy(F.desc("version"), F.desc("build")).first()
    return (row.version, f"{root.rstrip('/')}/builds/{row.build}") if row else None


def _publish(spark: SparkSession, root: str, build: str) -> None:
    version = (latest_build(spark, root) or (0, ""))[0] + 1
    spark.range(1).select(F.lit(version).cast("long").alias("version"),
                          F.lit(build).alias("build")).coalesce(1).write.mode("append").parquet(
        f"{root}/{PUBLISHED}")


def remove_old_builds(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Removes all published builds but the latest ``keep`` (at least one); returns their names.
    Call it when no reader of an old build is left."""
    root, found = root.rstrip("/"), published_builds(spark, root.rstrip("/"))
    rows = [] if found is None else found.orderBy(F.desc("version"), F.desc("build")).collect()
    old = [r.build for r in rows[max(1, keep):]]
    for build in old:
        remove_folder(spark, f"{root}/builds/{build}")
    return old


# --- model tables

def write_tables(wh: Warehouse, out_dir: str, names: list[str] | None = None,
                 fmt: str = "parquet", buckets: int | None = None) -> DataFrame:
    """Write the requested models in build order as a new build, then publish it.

    After each write the model is re-bound to the written table, so later
    models read it instead of recomputing its lineage (each model is a
    materialisation barrier, and a lost executor only recomputes from the
    last written table). ``out_dir`` should be a shared folder; models go to
    ``<out_dir>/builds/<build>/<model>``.

    The writes count their rows and what the audit asks of the raw sources and
    the marts as they go (observed metrics), so neither the manifest nor
    ``quality.audit`` after a build scans a source again.

    With ``buckets``, every model keyed by ``account_id`` is written as a
    table bucketed on it (same count for all), so later joins, aggregates and
    windows on ``account_id`` between them read co-located buckets instead of
    shuffling. Each model is hash-partitioned into the buckets before the
    write, so a bucket is one file, not one file per writing task. Worth it
    when reports run over the built tables at scale; at small scale the write
    costs more than the shuffles it saves. Returns the manifest (layer, table,
    rows, path).
    """
    wanted = set(names or MODEL_NAMES)
    spark, root, build = wh.spark, out_dir.rstrip("/"), uuid.uuid4().hex
    tag = hashlib.sha1(f"{root}/{build}".encode()).hexdigest()[:10]
    observed: dict[str, int] = {}
    rows: list[tuple[str, str, int, str]] = []

    def metrics(observation: Observation, prefix: str) -> None:
        observed.update({f"{prefix}.{k}": int(v or 0) for k, v in observation.get.items()})

    for name in MODEL_NAMES:  # build order
        if name not in wanted:
            continue
        source = name.removeprefix("stg_") if name.startswith("stg_") else None
        watch_raw = None
        if source in RAW_METRICS and not wh.is_bound(name):
            watch_raw = Observation(f"{source}-{build}")
            df = wh.built_on(name, source, wh.raw(source).observe(
                watch_raw, *[expr().alias(k) for k, expr in RAW_METRICS[source].items()]))
        else:
            df = wh.table(name)
        watch = Observation(f"{name}-{build}")
        df = df.observe(watch, F.count(F.lit(1)).alias("rows"),
                        *[expr().alias(k) for k, expr in BUILT_METRICS.get(name, {}).items()])
        path = f"{root}/builds/{build}/{name}"
        if buckets and "account_id" in df.columns:
            table = f"ah_{tag}_{name}"
            (df.repartition(buckets, "account_id")
             .write.mode("overwrite").format(fmt).bucketBy(buckets, "account_id")
             .option("path", path).saveAsTable(table))
            wh.bind(name, spark.table(table))
        else:
            df.write.mode("overwrite").format(fmt).save(path)
            wh.bind(name, spark.read.format(fmt).schema(df.schema).load(path))
        metrics(watch, name)
        if watch_raw is not None:
            metrics(watch_raw, source)
        rows.append((LAYER[name], name, observed[f"{name}.rows"], path))

    wh.observed, wh.buckets = observed_checks(observed), buckets
    if wh.observed:
        spark.createDataFrame(sorted(wh.observed.items()), "name string, observed long").coalesce(
            1).write.parquet(f"{root}/builds/{build}/{OBSERVED}")
    _publish(spark, root, build)
    return spark.createDataFrame(sorted(rows, key=lambda r: r[1]),
                                 "layer string, table string, rows long, path string")


def read_built(spark: SparkSession, root: str, sources=None) -> Warehouse:
    """Models bound to the latest published build under ``root`` (``write_tables`` output), so
    reports run without rebuilding; the audit takes what the build has observed."""
    found = latest_build(spark, root)
    if found is None:
        raise FileNotFoundError(f"No published build under {root}")
    wh = Warehouse(spark, sources or {})
    for name in MODEL_NAMES:
        wh.bind(name, spark.read.parquet(f"{found[1]}/{name}"))
    if folder_exists(spark, f"{found[1]}/{OBSERVED}"):  # a build of some models has none
        wh.observed = {r.name: r.observed
                       for r in spark.read.parquet(f"{found[1]}/{OBSERVED}").collect()}
    return wh


def audit_document(audit: DataFrame) -> DataFrame:
    """S6 shape: one row ``{summary: {...}, checks: [...]}`` from one
    aggregate over the ten check rows (no join)."""
    s = F.col("status")
    agg = audit.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(s == "pass").alias("passed"),
        F.count_if(s == "warn").alias("warnings"),
        F.count_if(s == "fail").alias("failed"),
        F.sort_array(F.collect_list(F.struct(*audit.columns))).alias("_checks"),
    )
    status = (F.when(F.col("failed") > 0, "fail").when(F.col("warnings") > 0, "warn")
              .otherwise("pass"))
    checks = F.transform("_checks", lambda c: F.struct(
        c["name"].alias("name"), c["status"].alias("status"), c["severity"].alias("severity"),
        c["observed"].alias("observed"), c["threshold"].alias("threshold"),
        c["detail"].alias("detail")))
    return agg.select(
        F.struct("total_checks", "passed", "warnings", "failed", status.alias("status"))
        .alias("summary"),
        checks.alias("checks"))


def write_audit_json(audit: DataFrame, path: str) -> None:
    """The audit document as a single JSON file under ``path``."""
    audit_document(audit).coalesce(1).write.mode("overwrite").json(path)


def write_account_details(detail: DataFrame, path: str) -> None:
    """One JSON line per account, partitioned by segment; nulls written
    as ``null``, dates and times as ISO-8601 text."""
    (detail.withColumn("segment", F.col("account.segment"))
     .write.mode("overwrite")
     .partitionBy("segment")
     .option("ignoreNullFields", "false")
     .option("dateFormat", "yyyy-MM-dd")
     .option("timestampNTZFormat", TIMESTAMP_TEXT)
     .json(path))


def queue_csv_frame(export: DataFrame) -> DataFrame:
    """S8 values: every field as the viewer's text (numbers without a
    trailing ``.0``, missing as empty)."""
    return export.select(*[js_string(F.col(f.name), f.dataType.typeName()).alias(f.name)
                           for f in export.schema.fields])


def write_queue_csv(export: DataFrame, path: str, single_file: bool = False) -> None:
    """Header line, every value quoted, quotes doubled, ``\\n`` lines.

    The export keeps its sort order across part files; ``single_file``
    gathers it into one part for small exports."""
    frame = queue_csv_frame(export)
    if single_file:
        frame = frame.coalesce(1)
    (frame.write.mode("overwrite")
     .option("header", True)
     .option("quoteAll", True)
     .option("escape", '"')
     .option("nullValue", "")
     .option("lineSep", "\n")
     .csv(path))
