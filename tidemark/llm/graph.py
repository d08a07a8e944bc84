"""Connected components over written edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.workspace import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """id and component (its smallest id) for every id in `edges` (columns a and b).

    Large and small stars alternate until the edges no longer change, so the number of rounds grows with the logarithm
    of a component's size. Every round is written, which cuts the lineage. No node's neighbours are gathered in one
    place: a round takes minima, which combine on the map side, and joins them back, which Spark splits when hot.
    """
    edges = materialise(_oriented(edges), "edges")
    before = None
    while before != (now := _fingerprint(edges)):
        before = now
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialise(small.union(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
    leaves = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return leaves.union(edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def _oriented(edges: DataFrame) -> DataFrame:
    edges = edges.where(F.col("a") != F.col("b"))
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
