"""Benchmark decontamination by greedy string tiling.

Texts are lower-cased words. Runs of five words that occur in benchmark items are the seeds; a document that holds
enough seeds of an item is tiled against it: the longest common run of words is marked in both, then the longest among
the words still unmarked, until no run of five is left. An item's coverage is the share of its words under tiles, so
passages are found in whatever order their parts stand. Items shorter than five words are their own single seed.

Seeds are found by running Karp-Rabin hashes over the whole text; equal hashes are checked word by word when a run is
extended. The benchmark is the stated query set: it is read in blocks of bounded size, and every block is compared with
all documents where they are read, without a shuffle.

Defined results: NULL and empty texts hold nothing, on either side. Repeated rows are compared once each. An item
repeated in the benchmark counts each time. Without items no document is contaminated.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, WordHashes, key_and_text, running_hashes, slices, texts_of
from tidemark.workspace import materialise

MIN_RUN = 5
COVERAGE = 0.5
BLOCK_CHARS = 16_000_000  # text of the items compared at once


class Items:
    """A block of benchmark items with the places of their seeds."""

    def __init__(self, items: list[tuple[int, str]], coverage: float, hashes: WordHashes):
        self.coverage, self.hashes = coverage, hashes
        self.keys = [k for k, _ in items]
        self.words = [np.fromiter(map(hashes.__getitem__, WORD.findall((t or "").lower())), np.uint64) for _, t in items]
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        by_length: dict[int, list[tuple[np.ndarray, int]]] = {}
        for number, words in enumerate(self.words):
            length = min(MIN_RUN, len(words))
            if length:
                by_length.setdefault(length, []).append((running_hashes(words, length), number))
        for length, found in by_length.items():
            hash_ = np.concatenate([h for h, _ in found])
            item = np.concatenate([np.full(len(h), n) for h, n in found])
            place = np.concatenate([np.arange(len(h)) for h, _ in found])
            order = np.argsort(hash_, kind="stable")
            hash_ = hash_[order]
            sieve = np.zeros(1 << 22, bool)  # most runs of a document are ruled out by one look
            sieve[hash_ & np.uint64((1 << 22) - 1)] = True
            self.seeds[length] = hash_, item[order], place[order], sieve

    def found_in(self, text: str) -> list[tuple[int, float, int]]:
        """Key, coverage and number of tiles of the items that reach the threshold."""
        ids = np.fromiter(map(self.hashes.__getitem__, WORD.findall(text.lower())), np.uint64)
        hits: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for length, (seed, item, place, sieve) in self.seeds.items():
            hash_ = running_hashes(ids, length)
            at = np.flatnonzero(sieve[hash_ & np.uint64((1 << 22) - 1)])
            if not len(at):
                continue
            low, high = (np.searchsorted(seed, hash_[at], side) for side in ("left", "right"))
            at, low, count = at[high > low], low[high > low], (high - low)[high > low]
            if not len(at):
                continue
            row = np.repeat(low - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
            at = np.repeat(at, count)
            order = np.argsort(item[row], kind="stable")
            bounds = np.flatnonzero(np.diff(item[row][order])) + 1
            for part in np.split(order, bounds):
                hits.setdefault(int(item[row[part[0]]]), []).append((at[part], place[row[part]]))
        out = []
        for number, groups in hits.items():
            for at, place in groups:
                covered, tiles = self._tile(ids, self.words[number], at, place)
                if covered >= self.coverage:
                    out.append((self.keys[number], covered, tiles))
        return out

    def _tile(self, text: np.ndarray, item: np.ndarray, at: np.ndarray, place: np.ndarray) -> tuple[float, int]:
        length = min(MIN_RUN, len(item))
        reach = np.zeros(len(item), bool)
        for i in range(length):
            reach[place + i] = True
        if reach.mean() < self.coverage:  # tiles consist of seeds, so they cover no more than these
            return 0.0, 0
        marked_text: set[int] = set()
        marked = np.zeros(len(item), bool)
        tiles = 0
        # Seeds on one diagonal without a gap are one common run.
        order = np.lexsort((at, at - place))
        at, place = at[order], place[order]
        cut = np.flatnonzero((np.diff(at - place) != 0) | (np.diff(at) != 1)) + 1
        runs = [(len(p) + length - 1, int(at[p[0]]), int(place[p[0]])) for p in np.split(np.arange(len(at)), cut)]
        runs = [(n, a, p) for n, a, p in runs if np.array_equal(text[a : a + n], item[p : p + n])]
        by_size: dict[int, list[tuple[int, int]]] = {}
        for n, a, p in runs:
            by_size.setdefault(n, []).append((a, p))
        for size in range(max(by_size, default=0), length - 1, -1):
            for a, p in by_size.get(size, []):
                free = [not marked[p + i] and a + i not in marked_text for i in range(size)]
                if all(free):
                    marked[p : p + size] = True
                    marked_text.update(range(a, a + size))
                    tiles += 1
                else:  # what is left of the run comes up again at its own length
                    start = None
                    for i, ok in enumerate([*free, False]):
                        if ok and start is None:
                            start = i
                        elif not ok and start is not None:
                            if i - start >= length:
                                by_size.setdefault(i - start, []).append((a + start, p + start))
                            start = None
        return float(marked.mean()), tiles


def blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of at most `block_chars` characters, or one item."""
    block, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("long"), "text").where(F.col("text").isNotNull())
    for key, text in rows.toLocalIterator():
        if block and size + len(text) > block_chars:
            yield block
            block, size = [], 0
        block.append((key, text))
        size += len(text)
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """One row per document and item of which the document holds at least `coverage`: the share and the tiles."""
    schema = "doc_id long, item_id long, coverage double, tiles int"
    rows = key_and_text(docs)

    def compare(block):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = Items(block, coverage, WordHashes())
            for batch in slices(batches):
                found = [(k, *f) for k, t in zip(batch.column("doc_id").to_pylist(), texts_of(batch)) for f in items.found_in(t)]
                columns = list(zip(*found)) or [()] * 4
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "item_id", "coverage", "tiles"])

        return rows.mapInArrow(run, schema)

    out = None
    for block in blocks(benchmark):
        found = compare(block)
        out = found if out is None else out.union(found)
    return rows.mapInArrow(lambda batches: iter(()), schema) if out is None else out


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The documents that hold no item to `coverage` or more, with all their columns."""

    def without(docs, block):
        def run(batches):
            items = Items(block, coverage, WordHashes())
            for batch in slices(batches):
                yield batch.filter(pa.array([not items.found_in(text) for text in texts_of(batch)], pa.bool_()))

        return docs.mapInArrow(run, docs.schema)

    for number, block in enumerate(blocks(benchmark)):
        # Written between blocks, so that a task holds one block at a time.
        docs = without(materialise(docs, "block") if number else docs, block)
    return docs
