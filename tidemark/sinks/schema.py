"""Target schemas derived from source schemas."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sinks.targets import DECLARED_TEXT, TableTarget

# The longest text the target declares, and the number type that replaces bigint there.
LONGEST_TEXT = 1000
BIGINT_AS = T.DecimalType(19, 0)


def map_type(dtype: T.DataType) -> T.DataType:
    """The target's type for a source type: bigint becomes NUMERIC(19), long text is declared shorter."""
    if isinstance(dtype, T.LongType):
        return BIGINT_AS
    if isinstance(dtype, T.VarcharType) and dtype.length > LONGEST_TEXT:
        return T.VarcharType(LONGEST_TEXT)
    return dtype


def _mapped_metadata(field: T.StructField) -> dict:
    """The field's metadata, a declared text length brought down to the longest the target declares."""
    declared = re.fullmatch(r"(?:var)?char\((\d+)\)", field.metadata.get(DECLARED_TEXT, ""))
    if declared is None or int(declared[1]) <= LONGEST_TEXT:
        return field.metadata
    return {**field.metadata, DECLARED_TEXT: f"varchar({LONGEST_TEXT})"}


def map_schema(schema: T.StructType) -> T.StructType:
    """Every field with its target type, names, nullability and declared text length kept.

    A table reports a text with a length as plain text and its length in the metadata; both forms are mapped. Spark
    refuses a value that is longer than declared, it does not cut it.
    """
    return T.StructType([
        T.StructField(f.name, map_type(f.dataType), f.nullable, _mapped_metadata(f)) for f in schema.fields])


def mapped(df: DataFrame) -> DataFrame:
    """The rows cast to the target's types."""
    return df.select(*[
        F.col(f"`{f.name}`").cast(map_type(f.dataType)).alias(f.name)
        if map_type(f.dataType) != f.dataType else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def create_like(spark: SparkSession, schema: T.StructType, name: str, *, prefix: str = "_") -> TableTarget:
    """Create the empty table `prefix + name` with the target types of `schema`."""
    target = TableTarget(f"{prefix}{name}", map_schema(schema))
    target.create(spark)
    return target
