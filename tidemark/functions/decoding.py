"""Code decoding: CASE expressions over a fixed list, and lookup tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unused_name(df: DataFrame, name: str) -> str:
    """`name`, lengthened until no column of `df` is called so in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _case(conditions: list[tuple[Column, str]], default: str | None) -> Column:
    (condition, code), *rest = conditions
    case = F.when(condition, F.lit(code))
    for condition, code in rest:
        case = case.when(condition, F.lit(code))
    return case.otherwise(F.lit(default))


def decode(col: Column, codes: Mapping[str, str], default: str | None = None, *, padded: bool = False) -> Column:
    """The code for a value, else `default`. With `padded`, blanks at the end of the value are ignored."""
    value = F.rtrim(col) if padded else col
    return _case([(value == text, code) for text, code in codes.items()], default)


def decode_like(col: Column, patterns: Mapping[str, str], default: str | None = None) -> Column:
    """The code of the first LIKE pattern that matches the value less the blanks at its end, else `default`."""
    value = F.rtrim(col)
    return _case([(value.like(pattern), code) for pattern, code in patterns.items()], default)


def decode_rank(col: Column, first: str, later: str, default: str) -> Column:
    """`first` for the text '1', `later` for a number above 1, else `default`; other text is no error."""
    return (
        F.when(col.cast("string") == "1", F.lit(first))
        .when(col.try_cast("double") > 1, F.lit(later))
        .otherwise(F.lit(default))
    )


def decode_lookup(
    df: DataFrame, lookup: DataFrame, value_col: str, code_col: str, out_col: str, *, on: str, default: str
) -> DataFrame:
    """Add `out_col`, the code that `lookup` gives for `df[on]`, or `default` where it has none.

    A value that `lookup` holds twice with the same code counts once; with different codes it is an error when the
    join runs. The input's own columns are kept whatever they are called. No broadcast is forced: Spark broadcasts the lookup if its
    size is below the session's threshold and shuffles otherwise.
    """
    codes = lookup.groupBy(F.col(value_col).alias("value")).agg(
        F.min(code_col).alias("low"), F.max(code_col).alias("high"))
    clash = F.raise_error(F.concat(F.lit("two codes for one value of the lookup: "), F.col("value").cast("string")))
    codes = codes.select(F.struct(
        "value", F.when(F.col("low") == F.col("high"), F.col("low")).when(F.col("low").isNotNull(), clash).alias("code")
    ).alias(unused_name(df, "lookup")))
    found = codes.columns[0]
    code = F.coalesce(codes[found]["code"], F.lit(default)).alias(out_col)
    joined = df.join(codes, df[on] == codes[found]["value"], "left")
    return joined.select(*[df[c] for c in df.columns if c != out_col], code)
