"""Language-model scores: a log-bilinear model trained by noise-contrastive estimation, and unigram scores beside them.

Tokens are the words between ASCII white space, A-Z lower-cased, and one end per text. Token counts come from all
training documents. The `SYMBOLS` most frequent tokens are symbols of the model; every other token belongs to one of
`CLASSES` classes by its last letters and is drawn from its class by its smoothed count, so that the model is a
distribution over all tokens.

The model predicts a vector from the two symbols before, r = C1 e(w-1) + C2 e(w-2), and scores a symbol by r q(w) + b(w).
Every partition of the training documents is passed through once by stochastic gradients against shared noise samples,
starting from the same parameters; the partitions' parameters are averaged by their numbers of tokens. As there are few
pairs of symbols, the sum over all symbols is then worked out for every pair, by batched matrix products in Spark tasks,
so scores are exactly normalised.

Scoring looks frequent tokens up where the document is read. Rare ones, beyond a table of `TABLE_TOKENS`, meet their
counts in a join, by document and token.

Defined results: a NULL or empty text is one end. Rows without a key are scored but not learned from. Repeated rows count
and are scored once each. Without any training document every base score is 0. Further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, key_and_text, most_frequent, slices, texts_of, trainable, word_hash
from tidemark.workspace import materialise

FOLDS, HELD_OUT_FOLD = 7, 2
SYMBOLS, CLASSES = 1000, 64
TABLE_TOKENS = 100_000
DIMENSIONS, NOISE, BATCH, RATE = 16, 32, 4096, 0.1
CACHE_TOKENS = 300_000
END = b""  # no word is empty


def tokens(text: str) -> list[bytes]:
    """The words of a text and its end."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and white space only
    words.append(END)
    return words


def word_class(token: bytes) -> int:
    return zlib.crc32(token[-2:]) % CLASSES


def _partial_counts(batches):
    held: Counter[bytes] = Counter()

    def counted():
        return pa.RecordBatch.from_arrays([
            pa.array(np.fromiter(map(word_hash, held), np.uint64, len(held)).view(np.int64)),
            pa.array([word_class(t) for t in held], pa.int32()), pa.array(held.values(), pa.int64()),
        ], names=["token", "class", "n"])

    for batch in slices(batches):
        for text in texts_of(batch):
            held.update(tokens(text))
            if len(held) > CACHE_TOKENS:
                yield counted()
                held.clear()
    if held:
        yield counted()


def count_tokens(docs: DataFrame) -> DataFrame:
    """token (a hash), class and n over all training documents, written."""
    rows = key_and_text(docs).where(trainable(F.col("doc_id"), FOLDS, HELD_OUT_FOLD)).select("text")
    counts = rows.mapInArrow(_partial_counts, "token long, class int, n long")
    return materialise(counts.groupBy("token", "class").agg(F.sum("n").alias("n")), "counts")


class Vocabulary:
    """What the driver and the tasks know of tokens: bounded tables of the frequent ones, totals of the others."""

    def __init__(self, counts: DataFrame):
        total = counts.agg(F.sum("n"), F.count("*")).first()
        self.n, self.v = int(total[0] or 0), int(total[1])
        top = most_frequent(counts, TABLE_TOKENS).toPandas().sort_values(["n", "token"], ascending=[False, True])
        hashes = top["token"].to_numpy().view(np.uint64).tolist()
        self.count = dict(zip(hashes, top["n"].tolist()))
        self.symbol = {h: i for i, h in enumerate(hashes[:SYMBOLS])}
        own = top.iloc[:SYMBOLS].groupby("class")["n"].agg(["sum", "size"])
        every = counts.groupBy("class").agg(F.sum("n").alias("sum"), F.count("*").alias("size")).toPandas().set_index("class")
        rest = every.sub(own, fill_value=0).reindex(range(CLASSES), fill_value=0)
        self.size = len(self.symbol) + CLASSES + 1  # the last symbol stands before a text
        frequency = np.r_[top["n"].to_numpy()[:SYMBOLS], rest["sum"].to_numpy(), 0].astype(np.float64) + 1
        self.frequency = frequency / frequency.sum()
        self.class_norm = np.log10(rest["sum"].to_numpy() + rest["size"].to_numpy() + 1.0)

    def symbol_of(self, token: bytes, hash_: int) -> int:
        return self.symbol.get(hash_, len(self.symbol) + word_class(token))


class Tokens:
    """Numbers of tokens with what is known of each, remembered up to a bound."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.seen = vocabulary, {}
        self._arrays(CACHE_TOKENS)

    def _arrays(self, size: int) -> None:
        self.symbol, self.hash = np.zeros(size, np.int32), np.zeros(size, np.uint64)
        self.log_count = np.zeros(size)  # log10(count + 1); NaN for tokens outside the table

    def numbers(self, found: list[bytes]) -> np.ndarray:
        if len(self.seen) + len(found) > len(self.symbol):
            self.seen.clear()
            if len(found) > len(self.symbol):
                self._arrays(len(found))
        at = list(map(self.seen.get, found))
        if None in at:
            at = [self._learn(t) if i is None else i for t, i in zip(found, at)]
        return np.array(at, np.int64)

    def _learn(self, token: bytes) -> int:
        if token in self.seen:
            return self.seen[token]
        at, hash_ = len(self.seen), word_hash(token)
        self.seen[token] = at
        self.hash[at], self.symbol[at] = hash_, self.vocabulary.symbol_of(token, hash_)
        count = self.vocabulary.count.get(hash_)
        self.log_count[at] = np.nan if count is None else np.log10(count + 1)
        return at


class LogBilinear:
    """Parameters, and one pass of noise-contrastive estimation."""

    def __init__(self, frequency: np.ndarray):
        draw = np.random.default_rng(7)
        size = len(frequency)
        self.e, self.q = (draw.normal(0, 0.1, (size, DIMENSIONS)).astype(np.float32) for _ in range(2))
        self.c = np.stack([np.eye(DIMENSIONS, dtype=np.float32)] * 2)
        self.noise = frequency
        self.b = np.log(frequency).astype(np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.e, self.q, self.c, self.b]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parameters()])

    def load(self, values: np.ndarray) -> None:
        at = 0
        for p in self.parameters():
            p[...] = values[at : at + p.size].reshape(p.shape)
            at += p.size

    def start(self, seed: int) -> None:
        self.draw = np.random.default_rng(seed)
        self.square = [np.full(p.shape, 1e-4, np.float32) for p in self.parameters()]
        self.log_noise = np.log(NOISE * self.noise).astype(np.float32)
        self.edges = np.cumsum(self.noise)

    def learn(self, one: np.ndarray, two: np.ndarray, target: np.ndarray) -> None:
        """A step on targets and the symbols one and two places before."""
        e1, e2 = self.e[one], self.e[two]
        r = e1 @ self.c[0] + e2 @ self.c[1]
        noise = np.minimum(np.searchsorted(self.edges, self.draw.random(NOISE)), len(self.noise) - 1)
        qt, qn = self.q[target], self.q[noise]
        st = np.einsum("ij,ij->i", r, qt) + self.b[target] - self.log_noise[target]
        sn = r @ qn.T + (self.b[noise] - self.log_noise[noise])
        gt = _sigmoid(st) - 1.0  # gradients of the loss by the scores
        gn = _sigmoid(sn)
        gr = gt[:, None] * qt + gn @ qn
        ge, gq, gc, gb = (np.zeros_like(p) for p in self.parameters())
        np.add.at(ge, one, gr @ self.c[0].T)
        np.add.at(ge, two, gr @ self.c[1].T)
        np.add.at(gq, target, gt[:, None] * r)
        np.add.at(gq, noise, gn.T @ r)
        gc[0], gc[1] = e1.T @ gr, e2.T @ gr
        gb += np.bincount(target, gt, len(gb)).astype(np.float32)
        np.add.at(gb, noise, gn.sum(axis=0))
        for p, square, g in zip(self.parameters(), self.square, (ge, gq, gc, gb)):
            g /= len(target)
            square += g * g
            p -= RATE * g / np.sqrt(square)

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """What a symbol one and two places before adds to the score of every symbol; the bias is in the first."""
        return (self.e @ self.c[0]) @ self.q.T + self.b, (self.e @ self.c[1]) @ self.q.T


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _before(symbols: np.ndarray, start: int, places: int) -> np.ndarray:
    return np.r_[np.full(min(places, len(symbols)), start, symbols.dtype), symbols[:-places]]


def train(docs: DataFrame, vocabulary: Vocabulary) -> LogBilinear:
    """The model after one pass over all training documents."""
    start = vocabulary.size - 1

    def run(batches):
        model, known = LogBilinear(vocabulary.frequency), Tokens(vocabulary)
        model.start(TaskContext.get().partitionId())
        held, size, learned = [], 0, 0
        for batch in slices(batches):
            for text in texts_of(batch):
                s = known.symbol[known.numbers(tokens(text))]
                held.append((_before(s, start, 1), _before(s, start, 2), s))
                size += len(s)
            if size >= 16 * BATCH:
                learned += _steps(model, held)
                held, size = [], 0
        if held:
            learned += _steps(model, held)
        if learned:
            values = model.flat().astype(np.float64)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.arange(len(values)), pa.int64()), pa.array(values * learned),
                pa.array(np.full(len(values), learned, np.int64))], names=["at", "value", "n"])

    rows = key_and_text(docs).where(trainable(F.col("doc_id"), FOLDS, HELD_OUT_FOLD)).select("text")
    parts = rows.mapInArrow(run, "at long, value double, n long")
    mean = parts.groupBy("at").agg((F.sum("value") / F.sum("n")).alias("value")).toPandas()
    model = LogBilinear(vocabulary.frequency)
    if len(mean):
        values = np.zeros(len(mean), np.float32)
        values[mean["at"].to_numpy()] = mean["value"].to_numpy()
        model.load(values)
    return model


def _steps(model: LogBilinear, held: list[tuple]) -> int:
    one, two, target = (np.concatenate(part) for part in zip(*held))
    order = model.draw.permutation(len(target))
    for start in range(0, len(order), BATCH):
        at = order[start : start + BATCH]
        model.learn(one[at], two[at], target[at])
    return len(target)


def log_sums(docs: DataFrame, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """For every pair of symbols before a place, the logarithm of the sum over all symbols there."""
    size = len(first)
    last = size - 1  # the symbol before a text never comes at a place

    def run(batches):
        for batch in batches:
            for one in batch.column("id").to_pylist():
                scores = first[one, :last] + second[:, :last]
                high = scores.max(axis=1)
                sums = (high + np.log(np.exp(scores - high[:, None]).sum(axis=1))).astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([one], pa.int64()), pa.array([sums.tobytes()], pa.binary())], names=["one", "sums"])

    found = docs.sparkSession.range(0, size, 1, 32).mapInArrow(run, "one long, sums binary").toPandas()
    out = np.zeros((size, size), np.float32)
    for one, sums in zip(found["one"], found["sums"]):
        out[one] = np.frombuffer(sums, np.float32)
    return out


def score(docs: DataFrame) -> DataFrame:
    """Counts and scores of every document, from a model learned from the same documents."""
    counts = count_tokens(docs)
    vocabulary = Vocabulary(counts)
    first, second = train(docs, vocabulary).tables()
    sums = log_sums(docs, first, second)
    start, own = vocabulary.size - 1, len(vocabulary.symbol)

    def run(batches):
        known, row = Tokens(vocabulary), TaskContext.get().partitionId() << 33
        for batch in slices(batches):
            out = []
            for text in texts_of(batch):
                at = known.numbers(tokens(text))
                s, log_count = known.symbol[at], known.log_count[at]
                one, two = _before(s, start, 1), _before(s, start, 2)
                model = (first[one, s] + second[two, s] - sums[one, two]).sum(dtype=np.float64) / np.log(10)
                rare = s >= own
                model -= vocabulary.class_norm[s[rare] - own].sum()
                unseen = np.isnan(log_count)
                hash_, n = np.unique(known.hash[at[unseen]], return_counts=True)
                out.append((
                    row, len(at), int(len(at) - unseen.sum()), float(log_count[~unseen].sum()),
                    float(model + log_count[rare & ~unseen].sum()), hash_.view(np.int64), n))
                row += 1
            columns = list(zip(*out))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                names=["doc_id", "held_out", "row", "n_tokens", "n_table", "base", "model", "rare", "times"])

    rows = key_and_text(docs).withColumn("held_out", held_out(F.col("doc_id"), FOLDS, HELD_OUT_FOLD))
    scored = materialise(rows.mapInArrow(
        run, "doc_id long, held_out boolean, row long, n_tokens long, n_table long, base double, model double, "
             "rare array<long>, times array<long>"), "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select(
        "row", F.col("r.rare").alias("token"), F.col("r.times").alias("times"))
    met = rare.join(counts.select("token", "n"), "token").groupBy("row").agg(
        F.sum("times").alias("known"), F.sum(F.log10(F.col("n") + 1.0) * F.col("times")).alias("logs"))
    out = scored.drop("rare", "times").join(met, "row", "left")
    logs = F.coalesce("logs", F.lit(0.0))
    norm = float(np.log10(vocabulary.n + vocabulary.v + 1.0))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_table") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.n).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
        (F.col("model") + logs).alias("score"))
