"""A training corpus from raw documents: filter, deduplicate, redact, pack.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes every stage's result as
Parquet below the shared checkpoint folder and reads it back as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reshift.llm import minhash, packing, pii, quality, toxicity
from reshift.llm.common import shared_table, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_quality(docs, table(spark, sf_dir, "labels"))


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_harmless(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_first(docs)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.replace_entities(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", harmless),
    ("near_dedup", near_dedup),
    ("pii", surrogates),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = shared_table(stage(spark, docs, sf_dir))
    return docs


# The tokenizer and the fitted models are beyond SQL; tests compare with a brute-force run.
ORACLE_SQL = None
