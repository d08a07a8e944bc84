"""NULL, blank and NaN handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What the empty string becomes when SQL Server converts it to another type.
EMPTY_TEXT_AS = {
    "string": "",
    "int": 0,
    "bigint": 0,
    "double": 0.0,
    "date": "1900-01-01",
    "timestamp": "1900-01-01 00:00:00",
    "timestamp_ntz": "1900-01-01 00:00:00",
}


def isnull_default(col: Column, dtype: str = "string") -> Column:
    """`ISNULL(col, '')` for a column of type `dtype`, the empty text converted to that type."""
    if dtype not in EMPTY_TEXT_AS:
        raise ValueError(f"no empty-text value for type {dtype!r}")
    return F.coalesce(col, F.lit(EMPTY_TEXT_AS[dtype]).cast(dtype))


def rtrim_text(col: Column) -> Column:
    """Value as text without trailing blanks."""
    return F.rtrim(col.cast("string"))


def pad_left(col: Column, width: int, fill: str) -> Column:
    """Text filled up on its left to at least `width`; longer text is kept whole."""
    return F.lpad(col, F.greatest(F.lit(width), F.length(col)), F.lit(fill))


def blank_to_null(col: Column) -> Column:
    """NULL where the text is empty or all blanks."""
    return F.when(F.rtrim(col) != "", col)


def equals_padded(col: Column, text: str) -> Column:
    """Equality that ignores trailing blanks on both sides; false, not NULL, for a NULL."""
    return F.coalesce(F.rtrim(col) == text.rstrip(" "), F.lit(False))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN as NULL in every float and double column."""
    floating = (T.FloatType, T.DoubleType)
    return df.select(*[
        F.when(~F.isnan(F.col(f"`{f.name}`")), F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, floating) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def concat_key(prefix: str, col: Column) -> Column:
    """`prefix` and the value as text; NULL if the value is NULL."""
    return F.concat(F.lit(prefix), col.cast("string"))
