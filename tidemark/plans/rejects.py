"""Rows whose texts cannot be read: split off by a load, with column and reason, and counted in the audit.

A feed made with `rejects=True` marks them in one more column, an array that is empty for rows that can be loaded. The load
takes rows with marks out of the batch it has landed, writes one row per mark to the reject table and goes on with the others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.specs import LOAD_COLUMN

REJECTS = "B_REJECTS"
NOT_A_DATE = "not a date"
REJECT_SCHEMA = T.StructType([
    T.StructField(LOAD_COLUMN, T.LongType()),
    *[T.StructField(n, T.StringType()) for n in ("TARGET_TABLE", "ROW_KEY", "COLUMN_NAME", "TEXT", "REASON")],
])


def reject_marks(checks: Mapping[str, tuple[Column, Column]], reason: str = NOT_A_DATE) -> Column:
    """The array of marks: for every column whose text is there while what it was read as is not."""
    marks = [
        F.when(text.isNotNull() & read.isNull(), F.struct(
            F.lit(name).alias("COLUMN_NAME"), text.cast("string").alias("TEXT"), F.lit(reason).alias("REASON")))
        for name, (text, read) in checks.items()
    ]
    return F.array_compact(F.array(*marks)).alias(REJECTS)


def accepted(batch: DataFrame) -> DataFrame:
    """The rows without marks, and without the column of marks."""
    return batch.where(F.size(REJECTS) == 0).drop(REJECTS)


def rejected(batch: DataFrame, keys: Sequence[str], target_table: str, load_id: int) -> DataFrame:
    """The reject table's rows: one per mark. `ROW_KEY` has the key's parts as text, parted by `|`."""
    key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    marked = batch.where(F.size(REJECTS) > 0).select(key.alias("ROW_KEY"), F.inline(REJECTS))
    return marked.select(
        F.lit(load_id).cast("long").alias(LOAD_COLUMN), F.lit(target_table).alias("TARGET_TABLE"), "ROW_KEY",
        "COLUMN_NAME", "TEXT", "REASON")
