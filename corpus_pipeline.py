"""The corpus pipeline: five training-data operators, one after the other.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet in the shared folder and read back as the next one's input.
All but the last return the columns of ``documents``.

Defined results: null and empty texts score 0, are one text of which the exact
dedup keeps one row, have no shingles, no words and no pieces. Rows without an
identifier are kept like others; of equal texts one without an identifier stays
only if all are. Rows that repeat an identifier and a text are one after the exact
dedup. A source's rows come once for each pass of the mix. Columns besides those
of ``documents`` pass through all stages but the last. An empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from accounthealth.llm import exact_dedup, mixing, ngram_join, sentencepieces, toxicity
from accounthealth.llm.frames import kept, scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least the threshold go; the classifier is fitted
    to the labelled rows of ``documents`` that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    labelled = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return toxicity.clean_documents(docs, toxicity.fit(spark, labelled, labels))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays."""
    return exact_dedup.unique_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, the one with the smallest doc_id stays."""
    return ngram_join.group_heads(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights, whole documents, one row for each pass."""
    return mixing.mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces, n-best scores and the round trip of every row that is left."""
    return sentencepieces.piece_counts(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("ngram_join", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

# The network and the n-best search have no SQL form: tests/llm holds every
# stage, and the whole run, against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with scratch(spark):  # what the stage has written on its way is removed
            docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
