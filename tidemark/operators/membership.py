"""Keeping the rows whose values occur, or do not occur, in another frame.

Both sides may be skewed. The right side of a semi or anti join cannot be split, so its values are made
distinct first, on the map side. The left side AQE splits, but only where both sides are exchanged for
this very join; the null-safe comparison has join keys of its own (value and null flag), so the
partitioning of the distinct values is not taken over and both sides are exchanged.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _other_values(other: DataFrame, on: Mapping[str, str]) -> DataFrame:
    return other.select(*[F.col(theirs).alias(f"_other_{i}") for i, theirs in enumerate(on.values())])


def _same(df: DataFrame, values: DataFrame, on: Mapping[str, str]) -> Column:
    pairs = [df[ours].eqNullSafe(values[f"_other_{i}"]) for i, ours in enumerate(on)]
    return reduce(lambda a, b: a & b, pairs)


def rows_in(df: DataFrame, other: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows of `df` whose columns equal those of some row of `other` (`on`: ours to theirs); NULL equals nothing."""
    values = _other_values(other, on).dropna().distinct()
    return df.join(values, _same(df, values, on), "left_semi")


def rows_not_in(df: DataFrame, other: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows of `df` whose columns equal those of no row of `other`; NULL equals NULL."""
    values = _other_values(other, on).distinct()
    return df.join(values, _same(df, values, on), "left_anti")


def mark_absent(df: DataFrame, other: DataFrame, on: Mapping[str, str], out_col: str) -> DataFrame:
    """All rows of `df` with a flag that is true for those `rows_not_in` would keep."""
    values = _other_values(other, on).distinct().withColumn("_present", F.lit(True))
    joined = df.join(values, _same(df, values, on), "left")
    return joined.select(*[df[c] for c in df.columns], values["_present"].isNull().alias(out_col))
