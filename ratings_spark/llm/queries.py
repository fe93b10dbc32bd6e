"""The queries of this subpackage: one an operator, and the corpus pipeline.

Each applies its operator with production parameters to the whole of its
tables. SQL stands beside those that it can express.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (
    classifier,
    collocations,
    exact_dedup,
    language_id,
    licenses,
    merkle,
    mixing,
    packing,
    pii,
    quality_rules,
    simhash,
    token_counts,
    wavelet,
)
from .common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(table(spark, sf_dir, "documents")).drop("n_chunks")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.round_trip(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_mixing, op3_pii, op4_exact_dedup, op5_packing, op6_quality, op7_wavelet,
    op8_simhash, op9_licenses, op10_token_counts, op11_collocations, op12_merkle,
    op13_language_id, pipeline)}
ORACLE = {
    "op1_quality_rules": quality_rules.ORACLE,
    "op2_mixing": mixing.ORACLE,
    "op4_exact_dedup": exact_dedup.ORACLE,
    "op9_licenses": licenses.oracle(),
    "op11_collocations": collocations.ORACLE,
    "op12_merkle": merkle.ORACLE,
}
