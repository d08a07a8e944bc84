"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

A text's words and adjacent word pairs are hashed into 2**18 features, with one feature for a word after itself; a text is its vector of feature counts scaled to
length one. Training rows are a bounded sample of the labelled documents, dealt over a few shards; each shard fits its
own weights with the per-coordinate proximal update, and the weights are averaged. L1 keeps most of them at zero. A
score is one sparse dot product per document, computed where the document is read, without a shuffle.

Defined results: a NULL text counts as empty, and an empty text scores by the bias alone. Documents without a label,
without a key, or whose labels contradict each other are scored but not learned from. Repeated rows are scored once
each. An empty table gives an empty result; without any label every score is 0.5. Further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_sample, held_out, key_and_text, slices, texts_of, trainable

BITS = 18
WORD = re.compile(r"\w+|[^\w\s]+")
FOLDS, HELD_OUT_FOLD = 3, 1
SAMPLE_ROWS = 8192  # at most so many labelled documents are learned from
SHARDS = 4
EPOCHS = 4
CACHE_WORDS = 400_000
REPEATED = np.uint32(0x5EED5EED)


class WordHashes(dict):
    """32-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        return value


def features(text: str, hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of a text; the values have Euclidean length one."""
    ids = np.fromiter(map(hashes.__getitem__, WORD.findall(text)), np.uint32)
    if not len(ids):
        return np.empty(0, np.int32), np.empty(0, np.float32)
    single = ids * np.uint32(0x9E3779B1)
    pair = (ids[:-1] * np.uint32(0x85EBCA6B)) ^ (ids[1:] * np.uint32(0xC2B2AE35) + np.uint32(0x27D4EB2F))
    pair[ids[:-1] == ids[1:]] = REPEATED  # all repetitions of a word at once count as one pair
    pair = (pair ^ (pair >> np.uint32(15))) * np.uint32(0x9E3779B1)
    number = np.sort(np.concatenate([single, pair]) >> np.uint32(32 - BITS))
    first = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
    count = np.diff(np.r_[first, len(number)]).astype(np.float32)
    return number[first].astype(np.int32), count / np.sqrt(count @ count)


class FollowTheLeader:
    """Logistic regression with the proximal follow-the-regularised-leader update, per coordinate.

    The bias is the last coordinate and is not regularised.
    """

    def __init__(self, size: int, alpha: float = 0.5, beta: float = 0.1, l1: float = 0.02, l2: float = 0.01):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, l1 = self.z[at], np.where(at == len(self.z) - 1, 0.0, self.l1)
        rate = (self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / rate)

    def learn(self, at: np.ndarray, value: np.ndarray, label: float) -> None:
        at, value = np.r_[at, len(self.z) - 1], np.r_[value, 1.0]
        w = self.weights(at)
        gradient = (sigmoid(w @ value) - label) * value
        step = (np.sqrt(self.n[at] + gradient**2) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += gradient - step * w
        self.n[at] += gradient**2


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _featurise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in slices(batches):
        found = [features(text, hashes) for text in texts_of(batch)]
        yield pa.RecordBatch.from_arrays([
            batch.column("shard"), batch.column("place"), batch.column("label"),
            pa.array([f[0] for f in found], pa.list_(pa.int32())),
            pa.array([f[1] for f in found], pa.list_(pa.float32())),
        ], names=["shard", "place", "label", "number", "value"])


def _fit_shard(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["place", "label"])
    model = FollowTheLeader(1 << BITS)
    examples = list(zip(rows["number"], rows["value"], rows["label"]))
    for _ in range(EPOCHS):
        for at, value, label in examples:
            model.learn(np.asarray(at), np.asarray(value), label)
    every = np.arange(len(model.z))
    w = model.weights(every)
    kept = np.union1d(np.flatnonzero(w), every[-1:])  # the bias always, which tells that there was a shard
    return pd.DataFrame({"number": kept, "weight": w[kept]})


def clean_labels(labels: DataFrame, column: str = "quality") -> DataFrame:
    """One row per labelled document; documents whose labels contradict each other have none."""
    each = labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1))
    each = each.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min(column).alias("low"), F.max(column).alias("label"))
    return each.where(F.col("low") == F.col("label")).select("doc_id", F.col("label").cast("double").alias("label"))


def one_text_each(rows: DataFrame) -> DataFrame:
    """One row per sampled key, that with the least text hash, so that repeated rows of a key do not meet in one task."""
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")
    return rows.groupBy("doc_id", "label", "place", "shard").agg(least).select("label", "place", "shard", "least.text")


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, column: str = "quality") -> np.ndarray:
    """Weights, the bias last, from at most `sample_rows` labelled documents outside the held-out fold.

    The sample follows from the hashes of the documents' keys, so it is the same for the same rows.
    Only the weights, at most 2**18 + 1 numbers, come to the driver.
    """
    place = F.xxhash64("doc_id")
    known = clean_labels(labels, column).where(trainable(F.col("doc_id"), FOLDS, HELD_OUT_FOLD))
    sample = bounded_sample(known, place, sample_rows).select(
        "doc_id", "label", place.alias("place"), F.pmod(F.shiftright(place, 40), F.lit(SHARDS)).cast("int").alias("shard"))
    # At most `sample_rows` narrow rows are broadcast.
    examples = one_text_each(key_and_text(docs).join(F.broadcast(sample), "doc_id")).select("shard", "place", "label", "text")
    examples = examples.mapInArrow(
        _featurise, "shard int, place long, label double, number array<int>, value array<float>")
    fitted = examples.groupBy("shard").applyInPandas(_fit_shard, "number long, weight double")
    found = fitted.groupBy("number").agg(F.sum("weight").alias("weight"), F.count("*").alias("shards")).toPandas()
    weights = np.zeros((1 << BITS) + 1, np.float32)
    # A shard without rows has no model and takes no part in the mean.
    weights[found["number"].to_numpy()] = found["weight"].to_numpy() / max(1, found["shards"].max() if len(found) else 1)
    return weights


def scorer(weights: np.ndarray):
    """A function from texts to scores between 0 and 1."""
    hashes = WordHashes()

    def score(texts: list[str]) -> np.ndarray:
        out = np.empty(len(texts))
        for i, text in enumerate(texts):
            at, value = features(text, hashes)
            out[i] = weights[at] @ value + weights[-1] if len(at) else weights[-1]
        return sigmoid(out)

    return score


def score_documents(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of `docs`."""

    def run(batches):
        score = scorer(weights)
        for batch in slices(batches):
            found = score(texts_of(batch))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("held_out"), pa.array(found, pa.float64()),
                pa.array((found >= 0.5).astype(np.int32), pa.int32()),
            ], names=["doc_id", "held_out", "score", "predicted"])

    rows = key_and_text(docs).withColumn("held_out", held_out(F.col("doc_id"), FOLDS, HELD_OUT_FOLD))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, weights: np.ndarray, threshold: float = 0.5) -> DataFrame:
    """The rows of `docs` that score at least `threshold`, with all their columns."""

    def run(batches):
        score = scorer(weights)
        for batch in slices(batches):
            yield batch.filter(pa.array(score(texts_of(batch)) >= threshold))

    return docs.mapInArrow(run, docs.schema)
