"""From documents to packed token sequences, stage by stage.

Each stage takes all rows its predecessor kept. Its result is written as Parquet to the folder the
cluster names in `spark.checkpoint.dir` and read again, so a failure costs one stage at most.
Columns beside `doc_id`, `text` and `n_chars` pass through, whatever their names, until packing;
every stage makes an empty table of an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marlstone.llm import exact_dedup, ngram_join, packing, quality_rules, secrets
from marlstone.llm.common import find_package, staged, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the rules keep, without the lines that break a rule. Null and blank texts go."""
    return with_length(quality_rules.cleaned(docs))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id; null and empty texts are equal."""
    find_package(spark)
    return exact_dedup.survivors(docs)


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least id.

    Documents without words or without an id stay.
    """
    find_package(spark)
    return ngram_join.one_per_component(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret in them replaced by its kind; null texts stay null."""
    find_package(spark)
    return with_length(secrets.redacted(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in the training sequences; a null text is its end id alone."""
    find_package(spark)
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_dedup_stage),
    ("n-gram Jaccard join", ngram_join_stage),
    ("secret scans", secret_stage),
    ("packing", packing_stage),
]

# Tokens are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def with_length(docs: DataFrame) -> DataFrame:
    """`n_chars` of the texts as they are now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
