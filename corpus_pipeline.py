"""From documents to packed training sequences: five stages of the dealt operators.

Each stage takes what the one before it kept, written as Parquet and read again, and
all but the last return the columns of ``documents``. Where a text changes, n_chars
follows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import line_rules, mixing, near_dedup, packing, secret_scan
from tidemark.llm.text import word_count
from tidemark.session import Scratch


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that fail the base limits or lose too much."""
    return _counted(line_rules.clean_documents(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return near_dedup.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return _counted(secret_scan.redact(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target takes it."""
    return mixing.mixed_documents(docs, word_count(F.col("text")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens and their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("secret scan", secrets),
    ("mixing", mixture),
    ("packing", packed),
]

# Near-duplicate components, the Markov models and the genetic packing are not SQL;
# tests/llm compares the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = scratch.put(stage(spark, docs, sf_dir), f"stage{n}")
        if n:
            scratch.drop(f"stage{n - 1}")
    return docs
