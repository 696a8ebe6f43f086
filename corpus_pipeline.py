"""From raw documents to packed sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lamina.llm import frames, line_dedup, packing, pii, quality, simhash


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier doesn't reject."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def first_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the lines that repeat an earlier one."""
    return line_dedup.dedup(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicate documents the one with the smallest id."""
    return simhash.keep_one(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by its kind."""
    return pii.redact(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the packed sequences."""
    return packing.packed(docs)


STAGES = [
    ("quality", good_documents),
    ("line_dedup", first_lines),
    ("near_duplicates", one_of_each_group),
    ("personal_data", without_personal_data),
    ("packing", sequences),
]

# The classifier is trained, so no SQL gives its rows; the tests hold the stages
# against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written and read again by the next."""
    docs = frames.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = frames.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
