"""A corpus pipeline over `documents`: quality, near duplicates, benchmark passages, personal data, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. All but the last return the
columns of the documents.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, minhash, packing, pii, quality
from tidemark.llm.common import importable
from tidemark.workspace import materialise


def stage(function):
    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        importable(spark)
        return function(spark, docs, sf_dir)

    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@stage
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


@stage
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near duplicates."""
    return minhash.deduplicate(docs)


@stage
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.remove_contaminated(docs, _table(spark, sf_dir, "benchmark"))


@stage
def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without personal data and the words that give it away."""
    return pii.sanitise(docs)


@stage
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("PII", pii_stage),
    ("best-fit packing", packing_stage),
]

# The classifier, the sampling and the tokeniser have no counterpart in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result but the last is written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for number, (_, function) in enumerate(STAGES, 1):
        docs = function(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = materialise(docs, "stage")
    return docs
