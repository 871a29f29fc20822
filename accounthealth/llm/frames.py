"""Helpers shared by the training-data operators.

``shared_dir`` names the folder that the driver and every executor can reach;
``staged`` writes a frame there as Parquet and reads it back, which cuts the
lineage and survives the loss of an executor.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed by the contracts: a word is a run of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    Only a local master (tests) may leave the setting out; a cluster without
    it is an error, as a machine-local folder would lose data there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_COLLECTED: list[list[str]] = []  # folders made inside the open ``scratch`` blocks


def new_folder(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _COLLECTED:
        _COLLECTED[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Folders made inside are removed at the end: read nothing of them afterwards. A frame that
    should outlive the block is written by ``kept``."""
    _COLLECTED.append([])
    try:
        yield
    finally:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in _COLLECTED.pop():
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)


def kept(df: DataFrame, name: str) -> DataFrame:
    """``staged``, but the folder stays when the innermost ``scratch`` block ends."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def word_count(col: str | Column) -> Column:
    """Number of words of a text; null counts 0."""
    return F.regexp_count(text_or_empty(col), F.lit(WORD_PATTERN)).cast("long")


def quoted(name: str) -> str:
    """``name`` as a column reference even when it holds dots or spaces."""
    return "`" + name.replace("`", "``") + "`"


def packed(df: DataFrame, *apart: str) -> Column:
    """All columns of ``df`` but ``apart`` in one struct, so that columns an
    operator adds cannot clash with them (empty structs become a null)."""
    rest = [F.col(quoted(c)) for c in df.columns if c not in apart]
    return F.struct(*rest) if rest else F.lit(None).cast("string")
