"""Near-duplicate documents: consistent weighted sampling over TF-IDF shingles, banded, verified exactly.

A document is the multiset of its five-word shingles (lower-cased words). A shingle weighs its count times a damped
inverse document frequency, between 1 and 1 + `RARITY` by the mean over its words; frequencies come from all documents. Every
task knows those of the `FREQUENT_WORDS` most frequent words, and a text's other words meet theirs in a join. Undamped, the words of a group
of copies that makes up much of the corpus would weigh next to nothing against the words in which the copies differ. Improved consistent weighted sampling draws `BANDS * ROWS` shingles
with probability proportional to weight; documents that agree in all draws of a band meet in a bucket.

Documents that meet, directly or through others, form a candidate group. Within a group every pair that shares a bucket
is verified by exact weighted Jaccard similarity, unless it is already linked through others. Large groups are dealt into
chunks, and every pair of chunks is compared in a task of its own, so that no group has to fit in one task. Texts with
equal words are one node throughout. Classes are the connected components of the links.

At similarity 0.8 a pair shares a bucket with probability 0.9992, at 0.9 with 0.999998.

Defined results: NULL and empty texts have no words and form one class of copies. A text of fewer than five words is one
shingle. A class is named by its smallest doc_id; the row with that key, and the smallest text hash among its repeats,
stays. Rows without a key belong to classes like others, and NULL sorts last when one is chosen.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, WordHashes, key_and_text, most_frequent, running_hashes, slices, texts_of, word_hash
from tidemark.llm.graph import connected_components
from tidemark.workspace import materialise

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 10, 3
FREQUENT_WORDS = 65_536
RARITY = 0.2
CHUNK = 256
WORDS_AT_ONCE = 2_000_000
CACHE_WORDS = 300_000


def _document_counts(batches):
    """How many documents hold each word, by its hash: partial counts of bounded size."""
    hashes, held, size = WordHashes(), [], 0

    def counted():
        word, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], names=["word", "n"])

    for batch in slices(batches):
        for text in texts_of(batch):
            held.append(np.fromiter(set(map(hashes.__getitem__, set(WORD.findall(text.lower())))), np.uint64))
            size += len(held[-1])
        if size > WORDS_AT_ONCE:
            yield counted()
            held, size = [], 0
    if held:
        yield counted()


def _weights(n: np.ndarray, total: int) -> np.ndarray:
    """What words weigh that `n` of `total` documents hold."""
    return 1 + RARITY * np.log1p(total / np.maximum(1, n)) / np.log1p(max(1, total))


class Frequencies:
    """Weights of words by hash: of the `frequent` ones, and of a word that one document holds.

    `rare` has text_hash and met, the words of a text that lie between, with the number of documents that hold each;
    None if there are none.
    """

    def __init__(self, total: int, frequent: dict[int, float], rare: DataFrame | None):
        self.total, self.frequent, self.rare = total, frequent, rare

    def joined(self, rows: DataFrame) -> DataFrame:
        """The rows with words and counts: those of the text's rare words."""
        if self.rare is None:
            return rows.select("*", F.lit(None).cast("array<long>").alias("words"), F.lit(None).cast("array<long>").alias("counts"))
        met = self.rare.select(F.col("text_hash").alias("r_hash"), F.col("met.word").alias("words"), F.col("met.n").alias("counts"))
        return rows.join(met, F.col("text_hash") == F.col("r_hash"), "left").drop("r_hash")

    def shingler(self) -> Callable[[], Shingler]:
        """What makes a task's shingler; holds no frame, so that it can be sent."""
        total, frequent = self.total, self.frequent
        return lambda: Shingler(frequent, float(_weights(np.ones(1), total)[0]), total)


def inverse_frequencies(docs: DataFrame) -> Frequencies:
    """The weights of all words. At most `FREQUENT_WORDS` numbers come to the driver; the others meet their texts by a join."""
    total = docs.count()
    counts = key_and_text(docs).select("text").mapInArrow(_document_counts, "word long, n long")
    counts = materialise(counts.groupBy("word").agg(F.sum("n").alias("n")), "frequencies")
    frequent = most_frequent(counts, FREQUENT_WORDS).toPandas()
    n, words = frequent["n"].to_numpy(), frequent["word"].to_numpy().view(np.uint64)
    known = dict(zip(words.tolist(), _weights(n, total).tolist()))
    between = counts.where((F.col("n") > 1) & (F.col("n") < F.lit(int(n.min()) if len(n) else total + 1)))
    if between.isEmpty():
        return Frequencies(total, known, None)

    def others(batches):
        hashes = WordHashes()
        for batch in slices(batches):
            found = []
            for text in texts_of(batch):
                held = set(map(hashes.__getitem__, set(WORD.findall(text.lower()))))
                found.append(np.fromiter(held.difference(known), np.uint64))
            text_hash = np.repeat(batch.column("text_hash").to_numpy(), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays([pa.array(text_hash), pa.array(np.concatenate(found).view(np.int64))], names=["text_hash", "word"])

    rows = key_and_text(docs).select("text", F.xxhash64("text").alias("text_hash"))
    # No word here is hot: those in many documents are known. Dealt by text first, as little would come together before.
    met = rows.mapInArrow(others, "text_hash long, word long").join(between, "word").repartition("text_hash")
    met = met.groupBy("text_hash").agg(F.collect_set(F.struct("word", "n")).alias("met"))
    return Frequencies(total, known, materialise(met, "rare"))


class Shingler:
    """Hashes and weights of a text's shingles, and its signature."""

    def __init__(self, frequencies: dict[int, float], rest: float, total: int):
        self.frequencies, self.rest, self.total = frequencies, rest, total
        self.place: dict[str, int] = {}
        self.hash = np.zeros(CACHE_WORDS, np.uint64)
        self.weight = np.zeros(CACHE_WORDS, np.float32)
        draw = np.random.default_rng(20240229)  # the same draws everywhere
        size = 1 << 16
        self.r = draw.gamma(2.0, 1.0, size).astype(np.float32)
        self.beta = draw.random(size).astype(np.float32)
        self.ln_c = np.log(draw.gamma(2.0, 1.0, size)).astype(np.float32)
        self.seed = draw.integers(1, 2**63, (BANDS * ROWS, 1), dtype=np.uint64)
        self.odd = draw.integers(1, 2**63, (BANDS * ROWS, 1), dtype=np.uint64) | np.uint64(1)

    def texts(self, batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        """The words of each text of a batch with the columns that `Frequencies.joined` adds."""
        words, counts = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("words", "counts"))
        # A word weighs the same in every text, so those of a batch are looked up as one.
        rare = dict(zip(words.view(np.uint64).tolist(), _weights(counts, self.total).tolist()))
        for text in texts_of(batch):
            yield self.words(text, rare)

    def words(self, text: str, rare: dict[int, float]) -> np.ndarray:
        found = WORD.findall(text.lower())
        if len(self.place) + len(found) > len(self.hash):
            self.place.clear()
            if len(found) > len(self.hash):
                self.hash, self.weight = np.zeros(len(found), np.uint64), np.zeros(len(found), np.float32)
        at = list(map(self.place.get, found))
        if None in at:
            at = [self._learn(w, rare) if i is None else i for w, i in zip(found, at)]
        return np.array(at, np.int64)

    def _learn(self, word: str, rare: dict[int, float]) -> int:
        if word in self.place:
            return self.place[word]
        at = self.place[word] = len(self.place)
        hash_ = word_hash(word.encode("utf-8", "surrogatepass"))
        known = self.frequencies.get(hash_)
        self.hash[at], self.weight[at] = hash_, rare.get(hash_, self.rest) if known is None else known
        return at

    def shingles(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles by hash, with their weights."""
        length = min(SHINGLE, len(words))
        if not length:
            return np.empty(0, np.uint64), np.empty(0, np.float32)
        hash_ = running_hashes(self.hash[words], length)
        total = np.r_[0.0, np.cumsum(self.weight[words], dtype=np.float64)]
        weight = (total[length:] - total[:-length]) / length
        order = np.argsort(hash_, kind="stable")
        hash_ = hash_[order]
        first = np.flatnonzero(np.r_[True, hash_[1:] != hash_[:-1]])
        count = np.diff(np.r_[first, len(hash_)])
        # Rounded, so that a shingle weighs exactly the same wherever it stands.
        return hash_[first], (count * np.round(weight[order][first], 3)).astype(np.float32)

    def digest(self, words: np.ndarray) -> bytes:
        return hashlib.blake2b(self.hash[words].tobytes(), digest_size=16).digest()

    def bands(self, hash_: np.ndarray, weight: np.ndarray) -> list[int]:
        """One number per band, equal where all the band's draws are."""
        if not len(hash_):
            return [0] * BANDS
        best = np.full(BANDS * ROWS, np.inf, np.float32)
        drawn = np.zeros(BANDS * ROWS, np.uint64)
        for start in range(0, len(hash_), 4096):
            part, ln_w = hash_[start : start + 4096], np.log(weight[start : start + 4096])
            mixed = (part ^ self.seed) * self.odd
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            one, two = mixed >> np.uint64(48), (mixed >> np.uint64(32)) & np.uint64(0xFFFF)
            r, beta = self.r[one], self.beta[one]
            t = np.floor(ln_w / r + beta)
            ln_a = self.ln_c[two] - r * (t - beta) - r
            low = ln_a.argmin(axis=1)
            rows = np.arange(BANDS * ROWS)
            value, step = ln_a[rows, low], t[rows, low].astype(np.int64).view(np.uint64)
            better = value < best
            best = np.where(better, value, best)
            drawn = np.where(better, part[low] ^ (step * np.uint64(0x94D049BB133111EB)), drawn)
        key = np.zeros(BANDS, np.uint64)
        for row in range(ROWS):
            key = (key ^ drawn[row::ROWS]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(31)
        return key.view(np.int64).tolist()


def sign(docs: DataFrame, frequencies: Frequencies) -> DataFrame:
    """One written row per document: its key, a hash of its text, a digest of its words, and its bands."""
    new_shingler = frequencies.shingler()

    def run(batches):
        shingler = new_shingler()
        for batch in slices(batches):
            digest, bands = [], []
            for words in shingler.texts(batch):
                digest.append(shingler.digest(words))
                bands.append(shingler.bands(*shingler.shingles(words)))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("text_hash"), pa.array(digest, pa.binary()),
                pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "text_hash", "digest", "bands"])

    rows = key_and_text(docs).withColumn("text_hash", F.xxhash64("text"))
    signed = frequencies.joined(rows).mapInArrow(run, "doc_id long, text_hash long, digest binary, bands array<long>")
    return materialise(signed, "signatures")


def candidate_groups(signed: DataFrame) -> DataFrame:
    """id (a digest) and component: the texts that share a bucket with another, by the group they meet in."""
    members = signed.select(F.col("digest").alias("a"), F.posexplode("bands").alias("band", "key")).distinct()
    buckets = members.groupBy("band", "key").agg(F.count("*").alias("n"), F.min("a").alias("b")).where(F.col("n") > 1)
    met = members.join(buckets, ["band", "key"]).where(F.col("a") != F.col("b")).select("a", "b")
    return materialise(connected_components(met), "groups")


class Roots(dict):
    """Union-find over row numbers."""

    def root(self, x):
        while (up := self.get(x, x)) != x:
            x = up
        return x


def _links(table: pa.Table, similarity: float) -> pa.Table:
    """Edges that connect all linked texts of one pair of chunks."""
    table = table.sort_by("digest")
    digest = table.column("digest").to_pylist()
    first = [i for i, d in enumerate(digest) if i == 0 or d != digest[i - 1]]
    table = table.take(first)
    digest = table.column("digest").to_pylist()
    hashes = [np.frombuffer(h, np.uint64) for h in table.column("hashes").to_pylist()]
    weights = [np.frombuffer(w, np.float32) for w in table.column("weights").to_pylist()]
    total = np.array([w.sum(dtype=np.float64) for w in weights])
    bands = np.array(table.column("bands").to_pylist())
    chunk = table.column("chunk").to_numpy()
    same_chunk = len(np.unique(chunk)) == 1
    roots, edges = Roots(), []
    for i in range(len(digest)):
        meets = (bands[i + 1 :] == bands[i]).any(axis=1)
        if not same_chunk:
            meets &= chunk[i + 1 :] != chunk[i]
        # No overlap of the lighter can make up for a heavier by more than the threshold allows.
        meets &= np.minimum(total[i + 1 :], total[i]) >= similarity * np.maximum(total[i + 1 :], total[i]) * (1 - 1e-9)
        for j in np.flatnonzero(meets) + i + 1:
            a, b = roots.root(i), roots.root(int(j))
            if a == b:
                continue
            _, at, to = np.intersect1d(hashes[i], hashes[j], assume_unique=True, return_indices=True)
            shared = np.minimum(weights[i][at], weights[j][to]).sum(dtype=np.float64)
            if shared >= similarity * (total[i] + total[j] - shared) - 1e-6:
                roots[b] = a
                edges.append((digest[i], digest[j]))
    columns = list(zip(*edges)) or [(), ()]
    return pa.table({"a": pa.array(columns[0], pa.binary()), "b": pa.array(columns[1], pa.binary())})


def links(docs: DataFrame, signed: DataFrame, groups: DataFrame, frequencies: Frequencies, similarity: float = SIMILARITY) -> DataFrame:
    """Edges (a, b) between digests that connect all texts of at least the given similarity that met."""
    sizes = groups.groupBy("component").agg(F.ceil(F.count("*") / F.lit(CHUNK)).cast("int").alias("chunks"))
    one_row = signed.groupBy("digest").agg(F.min(F.struct("doc_id", "text_hash")).alias("row"))
    wanted = frequencies.joined(
        groups.join(sizes, "component").join(one_row, F.col("id") == F.col("digest"))
        .select(F.col("row.doc_id").alias("w_doc_id"), F.col("row.text_hash").alias("text_hash"), "component", "chunks",
                F.pmod(F.xxhash64("digest"), F.col("chunks")).cast("int").alias("chunk")))
    wanted = wanted.withColumnRenamed("text_hash", "w_hash")
    rows = key_and_text(docs).withColumn("text_hash", F.xxhash64("text"))
    rows = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("w_doc_id")) & (F.col("text_hash") == F.col("w_hash")))

    new_shingler = frequencies.shingler()

    def run(batches):
        shingler = new_shingler()
        for batch in slices(batches):
            digest, hashes, weights, bands = [], [], [], []
            for words in shingler.texts(batch):
                hash_, weight = shingler.shingles(words)
                digest.append(shingler.digest(words))
                hashes.append(hash_.tobytes())
                weights.append(weight.tobytes())
                bands.append(shingler.bands(hash_, weight))
            yield pa.RecordBatch.from_arrays([
                batch.column("component"), batch.column("chunk"), batch.column("chunks"), pa.array(digest, pa.binary()),
                pa.array(hashes, pa.binary()), pa.array(weights, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["component", "chunk", "chunks", "digest", "hashes", "weights", "bands"])

    rows = rows.select("component", "chunk", "chunks", "text", "words", "counts").mapInArrow(
        run, "component binary, chunk int, chunks int, digest binary, hashes binary, weights binary, bands array<long>")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    keys = ["component", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high")]
    # A pair of different chunks also compares nothing within a chunk: that is done where a chunk meets itself.
    grouped = rows.groupBy(*keys)
    return grouped.applyInArrow(lambda t: _links(t, similarity), "a binary, b binary")


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, text_hash, class_id, kept for every row of `docs`."""
    frequencies = inverse_frequencies(docs)
    signed = sign(docs, frequencies)
    found = links(docs, signed, candidate_groups(signed), frequencies, similarity)
    linked = materialise(connected_components(found), "classes")
    rows = signed.join(linked, F.col("digest") == F.col("id"), "left").select(
        "doc_id", "text_hash", F.coalesce("component", "digest").alias("class"))
    key = F.struct(F.col("doc_id").isNull().alias("no_key"), "doc_id", "text_hash")
    first = rows.groupBy("class").agg(F.min(key).alias("first"))
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    # Compared null-safe, the join has keys of its own and its left side is split where a class is large.
    rows = rows.join(first.withColumnRenamed("class", "of"), F.col("class").eqNullSafe(F.col("of")))
    return rows.select("doc_id", "text_hash", F.col("first.doc_id").alias("class_id"), same.alias("kept"))


def deduplicate(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of every class, with all its columns."""
    kept = classes(docs, similarity).where("kept").groupBy("doc_id", "text_hash").agg(F.count("*").alias("n"))
    kept = materialise(kept, "kept").withColumnsRenamed({"doc_id": "k_doc_id", "text_hash": "k_hash"})
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("k_doc_id")) & (F.col("text_hash") == F.col("k_hash"))
    single = rows.join(kept.where("n = 1"), same, "left_semi").select("row.*")
    repeated = rows.join(kept.where("n > 1"), same, "left_semi").dropDuplicates(["doc_id", "text_hash"]).select("row.*")
    return single.union(repeated)
