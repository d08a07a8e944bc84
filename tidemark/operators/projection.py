"""Projections, filters and unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.specs import LOAD_COLUMN


def stamp_load_id(df: DataFrame, load_id: int | Column, load_col: str = LOAD_COLUMN) -> DataFrame:
    """The load id as first column, before all columns of `df`."""
    if load_col in df.columns:
        raise ValueError(f"the batch already has a column {load_col}")
    value = load_id if isinstance(load_id, Column) else F.lit(load_id)
    return df.select(value.cast("bigint").alias(load_col), "*")


def project_rename(df: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    """Output columns by name, each from a source column or an expression."""
    return df.select(*[
        (F.col(f"`{source}`") if isinstance(source, str) else source).alias(name)
        for name, source in columns.items()
    ])


def constant_columns(df: DataFrame, **constants: Any) -> DataFrame:
    """Append constants; a Python int stays a number and a str stays text."""
    return df.select("*", *[F.lit(value).alias(name) for name, value in constants.items()])


def positional_columns(df: DataFrame) -> DataFrame:
    """The same columns, named by position from 0."""
    return df.toDF(*[str(i) for i in range(len(df.columns))])


def not_in(col: Column, values: Sequence[str]) -> Column:
    """`col NOT IN (values)`, blanks at the end ignored on both sides; NULL for a NULL, so a filter drops it."""
    return ~F.rtrim(col).isin(*[value.rstrip(" ") for value in values])


def active_at(as_of: Column, start: Column, end: Column) -> Column:
    """Whether `as_of` lies in `[start, end]`; a missing end is open, a missing start is never active."""
    return as_of.between(start, F.coalesce(end, as_of))


def union_all_padded(first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION ALL by name, a column absent from one side filled with NULL of the other side's type."""
    result = first
    for other in others:
        result = result.unionByName(other, allowMissingColumns=True)
    return result
