"""Intermediate tables in the folder all executors share.

A frame that must be computed once and then read several times is written as parquet and read back.
The files outlive any executor, and readers touch only the columns they need.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`; where it is unset, one below the session's warehouse."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_tidemark"
    return folder.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and return a frame that reads it back, cutting the lineage.

    The files stay, since the frame is lazy: `intermediates` removes them, or else the folder's own retention.
    """
    return written(df, kept_path(df.sparkSession, label))


def kept_path(spark: SparkSession, label: str) -> str:
    """A new path that the surrounding `intermediates` removes, if there is one."""
    path = new_path(spark, label)
    if (paths := _OPEN.get()) is not None:
        paths.append(path)
    return path


_OPEN: ContextVar[list[str] | None] = ContextVar("open_intermediates", default=None)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Removes what `materialise` writes within the block when the block ends, well or not.

    Frames made in the block are lazy, so they must be written or otherwise used up within it.
    """
    paths: list[str] = []
    token = _OPEN.set(paths)
    try:
        yield
    finally:
        _OPEN.reset(token)
        for path in paths:
            delete_folder(spark, path)


@contextmanager
def landed(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """`materialise` for the length of a block; the files are removed when it ends well and kept when it fails."""
    path = new_path(df.sparkSession, label)
    yield written(df, path)
    delete_folder(df.sparkSession, path)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of what is run within the block as soon as it ends, not when the driver collects garbage.

    Meant for frames that are run once: run again, a frame makes its shuffles anew.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def written(df: DataFrame, path: str) -> DataFrame:
    """Write `df` to a path and return a frame that reads it back; the shuffle files behind it are removed."""
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file(spark: SparkSession, path: str):
    """A path with the file system it lies on."""
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    return file, file.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with everything in it, on whatever file system it lies."""
    folder, system = _file(spark, path)
    system.delete(folder, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names of what lies in a folder; none if there is no folder."""
    folder, system = _file(spark, path)
    return sorted(status.getPath().getName() for status in system.listStatus(folder)) if system.exists(folder) else []


def folder_bytes(spark: SparkSession, path: str) -> int:
    """The bytes of a file, or of all files below a folder."""
    folder, system = _file(spark, path)
    return system.getContentSummary(folder).getLength()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    file, system = _file(spark, path)
    stream = system.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole or not at all. False, and nothing written, if there is one of that name."""
    file, system = _file(spark, path)
    if system.exists(file):
        return False
    part, _ = _file(spark, f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
    stream = system.create(part, False)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    if system.rename(part, file):
        return True
    system.delete(part, False)
    return False


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows of `schema`, known to the optimiser as empty, so joins with it fold away."""
    nothing = spark.range(1).where(F.lit(False))
    return nothing.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
