"""Session settings the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Correctness does not depend on any of these. AQE is what splits a hot key in the joins, joins by
# broadcast when a side proves small at run time, and merges small shuffle partitions, so
# `spark.sql.shuffle.partitions` can be set for the largest load and left there.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.scheduler.mode": "FAIR",
}


# A shuffle partition of this size is sorted in an executor's memory without spilling much.
SHUFFLE_PARTITION_BYTES = 128 * 1024**2


def shuffle_partitions(bytes_shuffled: int, at_least: int = 8) -> int:
    """Value for `spark.sql.shuffle.partitions` when the largest shuffle moves `bytes_shuffled`.

    Rather too many than too few: AQE merges small ones and cannot divide large ones except in joins.
    """
    return max(at_least, -(-bytes_shuffled // SHUFFLE_PARTITION_BYTES))


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended settings; keyword settings (dots as `__`) override them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**RECOMMENDED, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
