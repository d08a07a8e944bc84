"""Row counts, column listings and view profiles."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_rows(df: DataFrame) -> DataFrame:
    """`COUNT(*)` as one row."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def view_profile(views: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, number of columns and column names of each view. On parquet the counts come from the file footers."""
    profiles = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("view_name"),
            "row_count",
            F.lit(len(df.columns)).alias("column_count"),
            F.lit(", ".join(df.columns)).alias("column_names"),
        )
        for name, df in views.items()
    ]
    return reduce(DataFrame.unionByName, profiles)


def describe_columns(df: DataFrame, table: str | None = None) -> DataFrame:
    """One row per column: position, name, type, whether NULL is allowed, and its default. No row is read.

    Names and types come from the frame's schema; `table` names the catalogue table whose declared nullability and
    defaults are given, without which the schema's nullability stands and defaults are NULL.
    """
    spark = df.sparkSession
    declared = {c.name: c for c in spark.catalog.listColumns(table)} if table else {}
    defaults = {f.name: f.metadata.get("CURRENT_DEFAULT") for f in (spark.table(table).schema if table else df.schema).fields}
    rows = [
        (i, f.name, f.dataType.simpleString(), declared[f.name].nullable if f.name in declared else f.nullable,
         defaults.get(f.name))
        for i, f in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(
        rows, "ordinal int, column_name string, data_type string, nullable boolean, default_value string")


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column with the number of its NULLs, found in one pass."""
    nulls = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)])
    return nulls.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("nulls")) for i, c in enumerate(df.columns)
    ])))
