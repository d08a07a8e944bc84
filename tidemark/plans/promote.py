"""The promotion manifest: which loads are to be promoted, and in which order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def promotion_manifest(audit: DataFrame, *, function: str, job: str, user: str) -> DataFrame:
    """One row per load that inserted something, numbered from 1 by hierarchy, then load id.

    `audit` has `hierarchy, load_id, target_table, inserted`, one row per load; a load id that occurs
    twice is an error. There is one load per feed and run, so the numbering window is tiny.
    """
    loads = audit.where(F.col("inserted") > 0).select("hierarchy", "load_id", "target_table")
    repeats = F.count(F.lit(1)).over(Window.partitionBy("load_id"))
    duplicate = F.raise_error(F.concat(F.lit("load id occurs twice: "), F.col("load_id").cast("string")))
    checked = loads.withColumn("load_id", F.when(repeats > 1, duplicate.cast("bigint")).otherwise(F.col("load_id")))
    return checked.select(
        F.row_number().over(Window.orderBy("hierarchy", "load_id")).alias("seq"),
        "hierarchy",
        "load_id",
        F.lit(function).alias("function"),
        F.lit(job).alias("job"),
        F.lit(user).alias("user"),
        F.col("target_table").alias("table"),
    )
