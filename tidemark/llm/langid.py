"""Language identification by cross-parsing entropy.

For each language, the distinct words of a bounded sample of labelled documents form a text, and the text a suffix
automaton. A document is parsed greedily against each automaton: every phrase is the longest piece that occurs in the
language's text. The fewer phrases a letter needs, the closer the document is to the language; the count is scaled by
the logarithm of the language's text, which makes languages with unequal samples comparable. Phrases end at word ends,
so a word's counts are worked out once and remembered.

The score is the runner-up's cost over the sum of the two lowest: one half when undecided, one when a single language
is known.

Defined results: a NULL text, or one without a letter, is `und` with score 0. Documents whose language is NULL are
predicted but not learned from; without any labelled document every prediction is `und`. Ties go to the first language
by name. Repeated rows are predicted once each; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, key_and_text, slices, texts_of, trainable

FOLDS, HELD_OUT_FOLD = 4, 2
SAMPLE_DOCUMENTS = 256  # at most so many documents of a language are learned from
SAMPLE_WORDS = 8000  # and so many of their distinct words, the most frequent first
LETTERS = re.compile(r"[^\W\d_]+")
UNDECIDED = "und"
CACHE_WORDS = 300_000


class SuffixAutomaton:
    """All substrings of a text, built letter by letter. Transitions are kept by state and letter in one table."""

    def __init__(self, text: str):
        self.moves: dict[tuple[int, str], int] = {}
        self.length, self.link, self.out = [0], [-1], [""]
        last = 0
        for letter in text:
            last = self._extend(last, letter)
        self.out = self.link = None  # only needed while building

    def _extend(self, last: int, letter: str) -> int:
        moves, length, link = self.moves, self.length, self.link
        state = self._state(length[last] + 1, "")
        at = last
        while at >= 0 and (at, letter) not in moves:
            self._move(at, letter, state)
            at = link[at]
        if at < 0:
            link[state] = 0
            return state
        other = moves[at, letter]
        if length[other] == length[at] + 1:
            link[state] = other
            return state
        copy = self._state(length[at] + 1, "")
        for follow in self.out[other]:
            self._move(copy, follow, moves[other, follow])
        link[copy] = link[other]
        while at >= 0 and moves.get((at, letter)) == other:
            moves[at, letter] = copy
            at = link[at]
        link[other] = link[state] = copy
        return state

    def _state(self, length: int, out: str) -> int:
        self.length.append(length)
        self.link.append(0)
        self.out.append(out)
        return len(self.length) - 1

    def _move(self, state: int, letter: str, to: int) -> None:
        self.moves[state, letter] = to
        self.out[state] += letter

    def phrases(self, text: str) -> int:
        """How many longest matches cover `text`; a letter unknown to the automaton is a phrase by itself."""
        count, state, moves = 0, 0, self.moves
        for letter in text:
            follow = moves.get((state, letter))
            if follow is None:
                count += state != 0
                follow = moves.get((0, letter))
                if follow is None:
                    count, follow = count + 1, 0
            state = follow
        return count + (state != 0)


class Languages:
    """The automata of all languages, and the costs of words remembered up to a bound."""

    def __init__(self, words: dict[str, list[str]]):
        self.names = sorted(words)
        texts = {name: " " + " ".join(words[name]) + " " for name in self.names}
        self.automata = [SuffixAutomaton(texts[name]) for name in self.names]
        self.bits = np.array([math.log2(len(texts[name]) + 1) for name in self.names])
        self.seen: dict[str, int] = {}
        self.costs = np.zeros((CACHE_WORDS, max(1, len(self.names))), np.int32)

    def _place(self, word: str) -> int:
        at = self.seen[word] = len(self.seen)
        padded = f" {word} "
        self.costs[at] = [a.phrases(padded) for a in self.automata]
        return at

    def _phrases(self, words: list[str]) -> np.ndarray:
        total = np.zeros(len(self.names), np.int64)
        for start in range(0, len(words), CACHE_WORDS // 2):
            part = words[start : start + CACHE_WORDS // 2]
            if len(self.seen) + len(part) > CACHE_WORDS:
                self.seen.clear()
            get = self.seen.get
            at = [get(w, -1) for w in part]
            if -1 in at:
                at = [get(w, -1) if i < 0 else i for w, i in zip(part, at)]
                at = [i if i >= 0 else (self.seen[w] if w in self.seen else self._place(w)) for w, i in zip(part, at)]
            total += np.take(self.costs, at, axis=0).sum(axis=0)
        return total

    def predict(self, text: str) -> tuple[str, float]:
        words = LETTERS.findall(text.lower())
        if not words or not self.names:
            return UNDECIDED, 0.0
        if len(self.names) == 1:
            return self.names[0], 1.0
        cost = self._phrases(words) * self.bits
        first, second = np.argsort(cost, kind="stable")[:2]
        return self.names[first], float(cost[second] / (cost[first] + cost[second]))


def _words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        lang, word, count = [], [], []
        for name, text in zip(batch.column("lang").to_pylist(), texts_of(batch)):
            found = LETTERS.findall(text.lower())
            numbers: dict[str, int] = {}
            for w in found:
                numbers[w] = numbers.get(w, 0) + 1
            lang += [name] * len(numbers)
            word += numbers
            count += numbers.values()
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.string()), pa.array(word, pa.string()), pa.array(count, pa.int64())],
            names=["lang", "word", "n"])


def train(docs: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS, sample_words: int = SAMPLE_WORDS) -> dict[str, list[str]]:
    """The words to learn from, by language.

    A language's documents are dealt by the hash of their key into `sample_documents` places, and the smallest hash of
    each place is taken, so that no task sees all rows of a language. At most `sample_words` words per language come to
    the driver.
    """
    place = F.xxhash64("doc_id")
    chosen = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang")
        .where(F.col("lang").isNotNull() & trainable(F.col("doc_id"), FOLDS, HELD_OUT_FOLD))
        .groupBy("lang", F.pmod(place, F.lit(sample_documents)).alias("place"))
        .agg(F.min(F.struct(place.alias("hash"), "doc_id")).alias("first"))
        .select("lang", F.col("first.doc_id").alias("doc_id"))
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
    # At most `sample_documents` keys per language are broadcast.
    rows = rows.join(F.broadcast(chosen), ["doc_id", "lang"]).select("lang", "text")
    words = rows.mapInArrow(_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    found = words.withColumn("rank", rank).where(F.col("rank") <= sample_words).select("lang", "word").toPandas()
    return {name: sorted(group["word"]) for name, group in found.groupby("lang")}


_LANGUAGES: dict[int, Languages] = {}


def predict_documents(docs: DataFrame, words: dict[str, list[str]]) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of `docs`."""

    def run(batches):
        key = hash(tuple((name, tuple(group)) for name, group in sorted(words.items())))
        if key not in _LANGUAGES:  # a worker builds the automata once
            _LANGUAGES.clear()
            _LANGUAGES[key] = Languages(words)
        languages = _LANGUAGES[key]
        for batch in slices(batches):
            found = [languages.predict(text) for text in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("held_out"), pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64()),
            ], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = key_and_text(docs).withColumn("held_out", held_out(F.col("doc_id"), FOLDS, HELD_OUT_FOLD))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
