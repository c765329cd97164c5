"""A corpus pipeline over `documents`: each stage calls one operator of casewatch.llm.

STAGES are (name, function) pairs. A function takes (spark, docs, sf_dir) and returns
a DataFrame, which is written as Parquet and read again as the next stage's docs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from casewatch.llm import bpe, mixing, quality_gam, quality_rules, simhash
from casewatch.llm.common import shared_folder, ship, table
from casewatch.llm.queries import vocabulary_file

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def predicted_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier learned from `labels` predicts as good."""
    return quality_gam.keep_good(docs, quality_gam.train(docs, table(spark, sf_dir, "labels")))


def passing_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no quality rule."""
    return quality_rules.keep_good(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies by SimHash: four-word shingles, up to 4 of 64 bits apart."""
    ship(spark)
    return simhash.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words of each document that the mix takes, one row per pass over its source."""
    ship(spark)
    return mixing.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each row's token ids and of the text decoded from them."""
    ship(spark)
    return bpe.token_counts(docs, vocabulary_file())


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", predicted_good),
    ("quality_rules", passing_rules),
    ("simhash", without_near_copies),
    ("mixing", mixed),
    ("bpe", encoded),
]

# Fingerprints, trained models and token ids are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written to the shared folder and read again."""
    folder = shared_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
