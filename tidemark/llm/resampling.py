"""Importance resampling: draws the documents whose word n-grams resemble those of a target set.

Texts are lower-cased (A to Z) and cut into words; features are all runs of one to three words, and a feature belongs to
the bucket that the crc32 of its bytes names. A bucket's gain is the logarithm of how much likelier it is in the target
than in the documents; a document's weight is the sum over its features. Gumbel noise from the document's key makes the
largest scores a draw without replacement in proportion to the weights' exponentials.

In a task, the n-grams of a piece of the texts are interned in an open-addressed NumPy table: all occurrences are hashed
(XXH64) at once, probe together, and share a slot only if their bytes are equal. A slot holds the n-gram's bucket, computed
once, and its count; occurrences keep slot numbers and gather through them. What goes on is every document's buckets in
two bytes each, written once, since the gains need the counts of all documents first: counts are sums of at most
`buckets` numbers per task, and gains (one number per bucket) go to the tasks with the function. The draw is a number
in a global sort of keys and scores only; no rank passes through one task.

Defined results: a NULL or empty text, or one without words, has no features and weight 0. Repeated rows are documents of
their own; they have equal noise, and of equal rows any one may be drawn first. A NULL key takes the noise of an empty
key and stands before other keys at equal scores. Long texts are cut into pieces between words. An empty table gives no
rows; an empty target is one whose buckets all count zero. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import key_and_text, text_bytes
from tidemark.operators.numbering import global_row_number
from tidemark.workspace import materialise

BUCKETS = 10_000
WORDS = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
PIECE_BYTES = 1 << 18
LONG = 256
SHIFTED = 64
FEATURES = "doc_id long, n_words long, buckets binary"
GATHERED = "doc_id long, n_words long, n_features long, weight long"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True

# The constants of XXH64.
P1, P2, P3, P4, P5 = (np.uint64(p) for p in (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))


FIRST_SUMS = [np.uint64(s & (1 << 64) - 1) for s in (int(P1) + int(P2), int(P2), 0, -int(P1))]


def _crc_shifts(most: int) -> np.ndarray:
    """What a crc32 becomes when 0 to `most` bytes follow, before these are mixed in: by length, byte of the crc and its value."""
    one = np.array([zlib.crc32(bytes([b])) for b in range(256)], np.uint32)
    # One more byte moves a crc's lowest byte through the table; the conditioning of zlib cancels out.
    table = one ^ one[0]
    tables = np.empty((most + 1, 4, 256), np.uint32)
    tables[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(most):
        tables[n + 1] = table[tables[n] & 255] ^ tables[n] >> np.uint32(8)
    return tables.reshape(-1)


CRC_SHIFTS = _crc_shifts(SHIFTED)


def _rotate(x: np.ndarray, by: int) -> np.ndarray:
    return x << np.uint64(by) | x >> np.uint64(64 - by)


def _round(total: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotate(total + lane * P2, 31) * P1


class Slices:
    """Byte strings that are slices of one buffer, hashed and compared many at a time."""

    def __init__(self, buffer: np.ndarray, start: np.ndarray, length: np.ndarray):
        self.buffer, self.start, self.length = buffer, start, length
        padded = np.concatenate([buffer, np.zeros(16, np.uint8)])
        # The eight bytes from every place on.
        self.eight = np.empty(len(buffer) + 1, np.uint64)
        for shift in range(8):
            whole = np.frombuffer(padded[shift : shift + (len(padded) - shift) // 8 * 8].tobytes(), "<u8")
            part = self.eight[shift::8]
            part[:] = whole[: len(part)]

    def bytes(self, i: int) -> bytes:
        return self.buffer[self.start[i] : self.start[i] + self.length[i]].tobytes()

    def hashes(self) -> np.ndarray:
        """XXH64, seed 0, of every slice. The few long ones go one by one."""
        at, rest = self.start.copy(), self.length.copy()
        total = self.length.astype(np.uint64) + P5
        long = np.flatnonzero(rest > LONG)
        rest[long] = 0
        wide = np.flatnonzero(rest >= 32)
        if len(wide):
            sums = [np.full(len(wide), s, np.uint64) for s in FIRST_SUMS]
            places, stripes = at[wide], rest[wide] // 32
            for stripe in range(int(stripes.max())):
                live = np.flatnonzero(stripes > stripe)
                for i in range(4):
                    sums[i][live] = _round(sums[i][live], self.eight.take(places[live] + 32 * stripe + 8 * i))
            merged = _rotate(sums[0], 1) + _rotate(sums[1], 7) + _rotate(sums[2], 12) + _rotate(sums[3], 18)
            for part in sums:
                merged = (merged ^ _round(np.zeros_like(part), part)) * P1 + P4
            total[wide] = merged + self.length[wide].astype(np.uint64)
            at[wide] += 32 * stripes
            rest[wide] -= 32 * stripes
        live = np.arange(len(at))
        while len(live := live[rest[live] >= 8]):
            lane = _round(np.zeros(len(live), np.uint64), self.eight.take(at[live]))
            total[live] = _rotate(total[live] ^ lane, 27) * P1 + P4
            at[live] += 8
            rest[live] -= 8
        live = np.flatnonzero(rest >= 4)
        lane = self.eight.take(at[live]) & np.uint64(0xFFFFFFFF)
        total[live] = _rotate(total[live] ^ lane * P1, 23) * P2 + P3
        at[live] += 4
        rest[live] -= 4
        live = np.flatnonzero(rest)
        while len(live):
            lane = self.eight.take(at[live]) & np.uint64(0xFF)
            total[live] = _rotate(total[live] ^ lane * P5, 11) * P1
            at[live] += 1
            rest[live] -= 1
            live = live[rest[live] > 0]
        total = (total ^ total >> np.uint64(33)) * P2
        total = (total ^ total >> np.uint64(29)) * P3
        total ^= total >> np.uint64(32)
        for i in long.tolist():
            total[i] = xxhash.xxh64_intdigest(self.bytes(i))
        return total

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether slices a and b have the same bytes, pair by pair."""
        same = self.length[a] == self.length[b]
        live = np.flatnonzero(same & (a != b))
        first, second, rest = self.start[a[live]], self.start[b[live]], self.length[a[live]]
        far = rest > LONG
        for i in live[far].tolist():
            same[i] = self.bytes(a[i]) == self.bytes(b[i])
        live, first, second, rest = live[~far], first[~far], second[~far], rest[~far]
        while len(live):
            differ = self.eight.take(first) ^ self.eight.take(second)
            short = rest < 8
            differ[short] &= (np.uint64(1) << (rest[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
            same[live[differ != 0]] = False
            on = (differ == 0) & (rest > 8)
            live, first, second, rest = live[on], first[on] + 8, second[on] + 8, rest[on] - 8
        return same


class Interned:
    """An open-addressed table of the distinct slices: `slot` by occurrence, `holder` and `count` by slot."""

    def __init__(self, slices: Slices):
        hashes = slices.hashes()
        n = len(hashes)
        size = 1 << max(4, (2 * n).bit_length())
        place = (hashes & np.uint64(size - 1)).astype(np.int32)
        key = np.zeros(size, np.uint64)
        holder = np.full(size, -1, np.int32)
        slot = np.empty(n, np.int32)
        left, at, sought = np.arange(n, dtype=np.int32), place, hashes
        while len(left):
            free = np.flatnonzero(holder.take(at) < 0)
            there = at[free]
            holder[there] = left[free]  # of several that meet, one stays
            key[there] = hashes.take(holder.take(there))
            found = np.flatnonzero(key.take(at) == sought)
            found = found[slices.equal(holder.take(at[found]), left[found])]
            slot[left[found]] = at[found]
            on = np.ones(len(left), bool)
            on[found] = False
            left, at, sought = left[on], (at[on] + 1) & (size - 1), sought[on]
        # Number the slots in use without gaps.
        used = holder >= 0
        self.slot = (np.cumsum(used, dtype=np.int32) - 1).take(slot)
        self.holder = holder[used]
        self.count = np.bincount(self.slot, minlength=len(self.holder))


def _followed(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The crcs' share in those of texts in which `length` bytes follow."""
    at = length * 1024
    shifted = CRC_SHIFTS.take(at + (crc & 255))
    for byte in (1, 2, 3):
        shifted = shifted ^ CRC_SHIFTS.take(at + 256 * byte + (crc >> np.uint32(8 * byte) & 255))
    return shifted


def gram_crcs(slices: Slices, words: int, sizes: list[int], word_at: np.ndarray, slots: Interned) -> np.ndarray:
    """crc32 by slot. The first `words` slices are the words themselves, the further ones runs of them: runs of two and so
    on, `sizes` of each, by their first word. A run's crc is put together from the words'; long words go one by one."""
    crc = np.zeros(len(slices.start), np.uint32)
    # Words first, each distinct one once.
    holders = slots.holder[slots.holder < words]
    view = memoryview(slices.buffer.tobytes())
    first = slices.start[holders]
    own = [zlib.crc32(view[a:b]) for a, b in zip(first.tolist(), (first + slices.length[holders]).tolist())]
    by_slot = np.zeros(len(slots.holder), np.uint32)
    by_slot[slots.slot[holders]] = own
    crc[:words] = by_slot[slots.slot[:words]]
    length = np.minimum(slices.length[:words], SHIFTED - 1)
    blank = np.full(words, zlib.crc32(b" "), np.uint32)
    after = _followed(blank, length) ^ crc[:words]  # a blank and the word
    before, at = np.arange(words), words
    for run, size in enumerate(sizes, 1):
        here = word_at[at : at + size]
        # The run of one word less that begins here; runs lie in order of their first word.
        shorter = before[here]
        crc[at : at + size] = _followed(crc[shorter], length[here + run] + 1) ^ after[here + run]
        before = np.zeros(words, np.int64)
        before[here] = np.arange(at, at + size)
        at += size
    found = crc[slots.holder]
    long = np.zeros(words + 1, np.int64)
    np.cumsum(slices.length[:words] >= SHIFTED, out=long[1:])
    holder_at, holder_run = word_at[slots.holder], np.searchsorted(np.cumsum([words, *sizes]), slots.holder, side="right")
    for slot in np.flatnonzero(long[holder_at + holder_run + 1] > long[holder_at]).tolist():
        found[slot] = zlib.crc32(slices.bytes(slots.holder[slot]))
    return found


def find_words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of texts that lie one after the other: a buffer of words with a blank after each, where they start and
    end there, and the number of words before each text."""
    data = _LOWER[data]
    inside = _IN_WORD[data]
    first = np.zeros(len(data) + 1, bool)
    first[bounds] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    of = np.cumsum(begins)
    letters = np.flatnonzero(inside)
    starts = np.flatnonzero(begins)
    buffer = np.full(len(letters) + len(starts), 32, np.uint8)
    buffer[np.arange(len(letters)) + of[letters] - 1] = data[letters]
    lengths = np.bincount(of[letters] - 1, minlength=len(starts)) if len(starts) else np.empty(0, np.int64)
    end = np.cumsum(lengths) + np.arange(len(starts))
    return buffer, end - lengths, end, np.searchsorted(starts, bounds)


def pieces(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about a piece's bytes; a longer text is a range of its own."""
    at = 0
    while at < len(bounds) - 1:
        upto = max(at + 1, int(np.searchsorted(bounds, bounds[at] + PIECE_BYTES, side="right")) - 1)
        yield at, upto
        at = upto


def occurrences(data: np.ndarray, bounds: np.ndarray, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words per text, features per text, and the features' buckets, text by text."""
    buffer, start, end, before = find_words(data, bounds)
    words = np.diff(before)
    text = np.repeat(np.arange(len(words)), words)
    left = before[1:][text] - np.arange(len(text))  # words from this one to its text's end
    firsts = [np.flatnonzero(left >= n) for n in range(1, longest + 1)]
    begin = np.concatenate(firsts)
    last = np.concatenate([f + n for n, f in enumerate(firsts)])
    slices = Slices(buffer, start[begin], end[last] - start[begin])
    table = Interned(slices)
    bucket = (gram_crcs(slices, len(text), [len(f) for f in firsts[1:]], begin, table) % buckets).astype(np.uint16)
    order = np.argsort(text[begin], kind="stable")
    features = np.bincount(text[begin], minlength=len(words))
    return words, features, bucket[table.slot[order]]


def _long_text(data: np.ndarray, longest: int, buckets: int) -> tuple[int, np.ndarray]:
    """Words and buckets of one long text in pieces that overlap by a feature less a word, each feature counted once."""
    n_words, parts, at, size, ahead = 0, [], 0, PIECE_BYTES, longest - 1
    while True:
        upto = min(at + size, len(data))
        ended = upto == len(data)
        _, start, end, _ = find_words(data[at:upto], np.array([0, upto - at]))
        if not ended and len(start) < 2 * longest + 2:
            size *= 2
            continue
        # The last word may go on beyond the piece, so it and the words that features of earlier ones need come again.
        here = len(start) if ended else len(start) - 1 - ahead
        places = _places(data[at:upto])
        cut = upto - at if ended else places[1][len(start) - 2]
        _, _, found = occurrences(data[at : at + cut], np.array([0, cut]), longest, buckets)
        if not ended:
            again = places[0][here]
            _, _, tail = occurrences(data[at + again : at + cut], np.array([0, cut - again]), longest, buckets)
            found = _without(found, tail, buckets)
        n_words += here
        parts.append(found)
        if ended:
            return n_words, np.concatenate(parts)
        at, size = at + int(places[0][here]), PIECE_BYTES


def _places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and end in the text itself."""
    inside = np.concatenate([[False], _IN_WORD[_LOWER[data]], [False]])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    return turns[::2], turns[1::2]


def _without(found: np.ndarray, tail: np.ndarray, buckets: int) -> np.ndarray:
    """`found` less the occurrences in `tail`; the order of a text's buckets has no meaning."""
    return np.repeat(np.arange(buckets, dtype=np.uint16),
                     np.bincount(found, minlength=buckets) - np.bincount(tail, minlength=buckets))


def features(docs: DataFrame, longest: int = WORDS, buckets: int = BUCKETS) -> DataFrame:
    """Every document's number of words, and the bucket of every feature as two bytes."""
    if buckets > 1 << 16:
        raise ValueError("a bucket's number has two bytes")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = text_bytes(batch.column("text"))
            for at, upto in pieces(bounds):
                part = data[bounds[at] : bounds[upto]]
                if len(part) > PIECE_BYTES and upto == at + 1:
                    n, found = _long_text(part, longest, buckets)
                    words, counts = np.array([n]), np.array([len(found)])
                else:
                    words, counts, found = occurrences(part, bounds[at : upto + 1] - bounds[at], longest, buckets)
                offsets = np.concatenate([[0], np.cumsum(2 * counts)]).astype(np.int32)
                stored = pa.Array.from_buffers(
                    pa.binary(), len(words), [None, pa.py_buffer(offsets), pa.py_buffer(found.astype("<u2"))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, upto - at), pa.array(words, pa.int64()), stored],
                    names=["doc_id", "n_words", "buckets"])

    return key_and_text(docs).mapInArrow(run, FEATURES)


def _stored(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bucket numbers of a batch, and where each row's begin and the last's end."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] // 2
    numbers = np.frombuffer(data, "<u2") if data is not None and data.size else np.empty(0, "<u2")
    return numbers[bounds[0] : bounds[-1]], bounds - bounds[0]


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all rows by bucket: one sum per task and bucket, added up by Spark, `buckets` rows at last."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_stored(batch.column("buckets"))[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], names=["bucket", "n"])

    sums = found.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets, np.int64)
    for bucket, n in sums.collect():
        counts[bucket] = n
    return counts


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of smoothed shares) by bucket."""
    s_all, t_all, buckets = int(source.sum()), int(target.sum()), len(source)
    return np.array([
        math.floor(1000 * math.log(((t + 1) * (s_all + buckets)) / ((s + 1) * (t_all + buckets))))
        for s, t in zip(source.tolist(), target.tolist())], np.int64)


def _weights(found: DataFrame, gains: np.ndarray) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, bounds = _stored(batch.column("buckets"))
            sums = np.concatenate([[0], np.cumsum(gains[numbers])])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), pa.array(np.diff(bounds)), pa.array(np.diff(sums[bounds]))],
                names=["doc_id", "n_words", "n_features", "weight"])

    return found.mapInArrow(run, GATHERED)


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    percent: int = PERCENT,
    longest: int = WORDS,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """Every document's features, weight and score, and its rank in the draw (NULL if not drawn).

    `percent` of the documents with at least `least_words` words are drawn. `target` needs a column `text`.
    """
    found = materialise(features(docs, longest, buckets), "features")
    sought = features(target.select(F.lit(None).alias("doc_id"), "text"), longest, buckets)
    weighed = _weights(found, bucket_gains(bucket_counts(found, buckets), bucket_counts(sought, buckets)))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = weighed.select(
        "doc_id", "n_features", "weight", (F.col("weight") + noise).alias("score"),
        (F.col("n_words") >= least_words).alias("eligible"))
    ranked = global_row_number(scored, [~F.col("eligible"), -F.col("score"), F.col("doc_id")], "rank",
                               tie_break=["weight"])
    drawn = percent * found.where(F.col("n_words") >= least_words).count() // 100
    return ranked.select(
        "doc_id", "n_features", "weight", "score", F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
