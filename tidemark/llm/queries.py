"""The training-data operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tidemark.llm import (
    decontaminate, html, langid, lm, minhash, packing, pii, prefix_trie, quality, resampling, substrings, token_counts, vectors)
from tidemark.llm.common import importable
from tidemark.llm.sql import OP11, OP13

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {"op11_importance_resampling": OP11, "op13_conversation_prefix_trie": OP13}


def query(function):
    """Register a function under its name."""

    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_pii_sanitisation(spark, sf_dir):
    """The personal data of every document, and the words that give it away."""
    return pii.find_spans(table(spark, sf_dir, "documents"))


@query
def op2_best_fit_packing(spark, sf_dir):
    """Every document's pieces with their places in sequences of 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op3_html_extraction(spark, sf_dir):
    """The main text of every page."""
    return html.extract(table(spark, sf_dir, "pages"))


@query
def op4_embedding_near_duplicates(spark, sf_dir):
    """The links and the component of every vector."""
    return vectors.link(table(spark, sf_dir, "embeddings"))


@query
def op5_benchmark_decontamination(spark, sf_dir):
    """Which documents hold which benchmark items, and how much of them."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_lm_scoring(spark, sf_dir):
    """Unigram and model scores of every document."""
    return lm.score(table(spark, sf_dir, "documents"))


@query
def op7_minhash_near_duplicates(spark, sf_dir):
    """The class of near duplicates of every document, and whether the document stays."""
    return minhash.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")


@query
def op8_quality_classifier(spark, sf_dir):
    """A quality score for every document."""
    docs = table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@query
def op9_substring_duplicates(spark, sf_dir):
    """Passages of fifty words and more that documents share, exactly or nearly."""
    return substrings.repeats(table(spark, sf_dir, "documents"))


@query
def op10_language_id(spark, sf_dir):
    """The language of every document."""
    docs = table(spark, sf_dir, "documents")
    return langid.predict_documents(docs, langid.train(docs))


@query
def op11_importance_resampling(spark, sf_dir):
    """The weight of every document for the benchmark's distribution, and its rank in the draw."""
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_token_counts(spark, sf_dir):
    """The tokens of every document."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


@query
def op13_conversation_prefix_trie(spark, sf_dir):
    """The nodes of the trie of rebuilt conversations."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


@query
def pipeline(spark, sf_dir):
    """Quality, near duplicates, benchmark passages, personal data, packing, one after the other."""
    return corpus_pipeline.run(spark, sf_dir)
