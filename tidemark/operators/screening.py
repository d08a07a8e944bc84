"""Telling new values from perhaps known ones by bit sets, so that only the latter are shuffled.

The known values' hashes set bits in a table of a fixed number of bits, `bits_per_value` for each value, kept as
Spark's bitmaps of 32,768 bits. A row that meets no bit is new for certain and stays where it is; the others go through the exact
join. The table is broadcast, and its size is known before it is made: where it would be more than `most_bytes`, all rows go
through the join. So the result is the same with any number of bits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.membership import rows_not_in

BITS_PER_VALUE = 16
MOST_BYTES = 64 * 1024**2
BITMAP_BITS = 8 * 4096


def table_bits(values: int, bits_per_value: int = BITS_PER_VALUE) -> int:
    """Bits of the table for so many values: a power of two, one bitmap at least."""
    return max(BITMAP_BITS, 1 << (max(values, 1) * bits_per_value - 1).bit_length())


def _place(columns: Sequence[Column], bits: int) -> Column:
    """The bit of a row's values, from 1; NULLs have one too."""
    nulls = [c.isNull() for c in columns]  # xxhash64 skips NULLs
    return F.pmod(F.xxhash64(*columns, *nulls), F.lit(bits)) + 1


def bit_sets(values: DataFrame, columns: Sequence[str], bits: int) -> DataFrame:
    """number and set of every bitmap that has a bit: merged on the map side, at most `bits` / 32768 rows per task."""
    place = _place([F.col(f"`{c}`") for c in columns], bits)
    placed = values.select(F.bitmap_bucket_number(place).alias("number"), F.bitmap_bit_position(place).alias("position"))
    return placed.groupBy("number").agg(F.bitmap_construct_agg("position").alias("set"))


def mark_perhaps_known(df: DataFrame, sets: DataFrame, columns: Sequence[str], bits: int) -> DataFrame:
    """`row`, a struct of the columns of `df`, and `known`: false only where no known value has the row's values."""
    place = _place([F.col(f"`{c}`") for c in columns], bits)
    placed = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        F.bitmap_bucket_number(place).alias("number"), F.bitmap_bit_position(place).alias("position"))
    byte = F.conv(F.hex(F.expr("substring(set, CAST(position DIV 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    known = byte.bitwiseAND(F.expr("shiftleft(1, CAST(position % 8 AS INT))")) != 0
    return placed.join(F.broadcast(sets), "number", "left").select("row", F.coalesce(known, F.lit(False)).alias("known"))


def screened_rows_not_in(
    df: DataFrame,
    other: DataFrame,
    columns: Sequence[str],
    *,
    bits_per_value: int = BITS_PER_VALUE,
    most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """Rows of `df` whose values in `columns` no row of `other` has; NULL equals NULL. Equal to `rows_not_in`.

    Counts `other` when called. `df` is read twice and should be a landed or stored table.
    """
    on = {c: c for c in columns}
    bits = table_bits(other.count(), bits_per_value)
    if bits // 8 > most_bytes:
        return rows_not_in(df, other, on)
    marked = mark_perhaps_known(df, bit_sets(other, columns, bits), columns, bits)
    back = lambda rows: rows.select(*[F.col("row").getField(c).alias(c) for c in df.columns])
    return back(marked.where(~F.col("known"))).unionByName(rows_not_in(back(marked.where("known")), other, on))
