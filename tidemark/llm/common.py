"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_ROWS = 256
WORD = re.compile(r"\w+")
CACHE_WORDS = 400_000
BASE = np.uint64(0x9E3779B97F4A7C15)


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package where it lies, whatever folder the driver was started in.

    On a cluster the package is installed or shipped with the job, and this path is merely one more to look in.
    """
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def fold(key: Column, of: int) -> Column:
    """The fold of a row: crc32 of its key as text, modulo `of`. A NULL key has no fold."""
    return F.crc32(key.cast("string")) % F.lit(of)


def held_out(key: Column, of: int, fold_number: int) -> Column:
    """True where the row belongs to the fold kept away from training; rows without a key are never held out."""
    return F.coalesce(fold(key, of) == F.lit(fold_number), F.lit(False))


def trainable(key: Column, of: int, fold_number: int) -> Column:
    """True where a model may learn from the row: it has a key, and that key is in another fold."""
    return F.coalesce(fold(key, of) != F.lit(fold_number), F.lit(False))


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches of a task in small pieces, so that a worker holds few texts as Python strings at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, NULL as the empty text."""
    return [text or "" for text in batch.column(column).to_pylist()]


def key_and_text(docs: DataFrame) -> DataFrame:
    """The two columns most operators need, whatever else the table has."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column's texts one after the other, and where each begins and the last ends."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def word_hash(word: bytes) -> int:
    """A 64-bit hash of a word."""
    return xxhash.xxh3_64_intdigest(word)


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = word_hash(word.encode("utf-8", "surrogatepass"))
        return value


def running_hashes(ids: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes, modulo 2**64, of all runs of `length` words."""
    n = len(ids) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(length):
        total = total * BASE + ids[i : i + n]
    return total ^ (total >> np.uint64(29))


BUCKETS = 4096


def bounded_sample(rows: DataFrame, place: Column, most: int) -> DataFrame:
    """At most `most` rows, the same ones for the same rows: those whose hash `place` falls into the first buckets.

    Only numbers of rows per bucket come to the driver, so no task and not the driver sees more than a bounded number.
    """
    shift = 0
    while True:
        bucket = F.pmod(F.shiftright(place, shift), F.lit(BUCKETS))
        sizes = sorted(rows.groupBy(bucket.alias("bucket")).count().collect())
        total, cut = 0, 0
        for number, size in sizes:
            total += size
            if total > most:
                break
            cut = number + 1
        if total <= most:
            return rows
        if cut or shift >= 48:
            return rows.where(bucket < cut)
        rows, shift = rows.where(bucket == sizes[0][0]), shift + 12


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The rows of `counts` with the largest n, at most `most` of them; rows with equal n stay or go together.

    A row's n is looked up in a histogram of bounded size, exact for small n and logarithmic for large.
    """
    n = F.col("n").cast("double")
    step = F.when(n < BUCKETS, n).otherwise(BUCKETS + F.floor(F.log2(n / BUCKETS) * 64)).cast("long")
    total, least = 0, None
    for number, size in sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True):
        total += size
        if total > most:
            break
        least = number
    if total <= most:
        return counts
    return counts.where(step >= least) if least is not None else counts.where(F.lit(False))
