"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), calls one operator of
``ratings_spark.llm`` with production parameters, and returns the rows that go
on, with the columns of documents (the last returns the packed pieces). Stages
are written as Parquet and reread, so each works on what its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ratings_spark.llm import classifier, exact_dedup, mixing, packing, simhash
from ratings_spark.llm.common import table
from ratings_spark.session import materialize


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows the quality classifier accepts."""
    return classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text."""
    return exact_dedup.keep_one(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies."""
    return simhash.keep_one(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in training order, each as often as the mix takes it."""
    return mixing.mix(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in training sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", good_documents),
    ("exact dedup", distinct_texts),
    ("simhash near-dedup", one_of_near_copies),
    ("mixing", mixed_sources),
    ("best-fit packing", packed_sequences),
]

# Fingerprints, a fitted model and token ids are beyond SQL; tests/llm compares
# the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs, "pipeline-" + name.replace(" ", "-"))
    return docs
