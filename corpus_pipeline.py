"""The corpus pipeline: stages over ``documents``, each written and read again.

Every stage works on all rows that the one before kept, and its decisions take
effect: rows go, or their text changes. All but the last return the columns of
``documents``; the last returns the mixture, one row per document and epoch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shardloom.llm.common import read
from shardloom.llm.decontaminate import remove_contaminated
from shardloom.llm.jaccard_join import keep_first
from shardloom.llm.mixing import mix_documents
from shardloom.llm.secret_scan import redact
from shardloom.llm.toxicity import remove_toxic
from shardloom.session import materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return remove_toxic(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group of texts that share 0.8 of their five-word shingles."""
    return keep_first(docs, n=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    return remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; every document stays."""
    return redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated and cut so that every source meets its share of the words."""
    return mix_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("ngram_jaccard_join", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scans", secrets),
    ("mixing", mixing),
]

#: A trained network and randomness tests are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
