"""The corpus pipeline: documents through quality, near copies, repeated passages, mixing and packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sievework.llm import mixing, packing, rule_quality, simhash, suffix_dedup
from sievework.llm.common import documents, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return rule_quality.quality(docs, labels).where("predicted = 1").select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: fingerprints of three-word shingles, two bits at most."""
    return simhash.distinct_documents(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 400 bytes or more that occur more than once are cut out; what is left stays."""
    return suffix_dedup.without_repeats(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of their sources takes them."""
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in training sequences: one row per piece of a document."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("packed", packed),
]
#: Learned rules, hashes of words and packing are not for SQL: tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage is stored and read again before the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
