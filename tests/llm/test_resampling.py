"""Importance resampling against a plain version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tests.llm.frames import awkward, empty
from tidemark.llm import resampling
from tidemark.llm.common import text_bytes

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def buckets_of(text):
    words = WORD.findall((text or "").translate(LOWER))
    grams = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), sorted(zlib.crc32(g.encode()) % 10_000 for g in grams)


def plain(docs, target):
    found = [(k, *buckets_of(t)) for k, t in docs]
    s, t = Counter(b for _, _, g in found for b in g), Counter(b for x in target for b in buckets_of(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log(((t[b] + 1) * (s_all + 10_000)) / ((s[b] + 1) * (t_all + 10_000))))
    rows = []
    for key, words, grams in found:
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, grams))
        rows.append((key, words, len(grams), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    drawn = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], -1 if r[0] is None else r[0]))
    drawn = drawn[: 5 * len(drawn) // 100]
    ranks = {id(r): n for n, r in enumerate(drawn, 1)}
    return sorted(((r[0], *r[2:], ranks.get(id(r))) for r in rows), key=str)


def test_hashes_are_xxh64():
    rng = random.Random(3)
    buffer = np.frombuffer(rng.randbytes(3000), np.uint8)
    start = np.array([rng.randrange(2000) for _ in range(900)])
    length = np.array([rng.randrange(0, rng.choice([5, 40, 400])) for _ in range(900)])
    slices = resampling.Slices(buffer, start, length)
    assert slices.hashes().tolist() == [xxhash.xxh64_intdigest(slices.bytes(i)) for i in range(900)]


def test_equal_hashes_of_different_bytes_stay_apart(monkeypatch):
    monkeypatch.setattr(resampling.Slices, "hashes", lambda self: np.full(len(self.start), 7, np.uint64))
    buffer = np.frombuffer(b"one two three one two four three", np.uint8)
    start, length = np.array([0, 4, 8, 14, 18, 22, 27]), np.array([3, 3, 5, 3, 3, 4, 5])
    table = resampling.Interned(resampling.Slices(buffer, start, length))
    slot = table.slot.tolist()
    assert slot[0] == slot[3] and slot[1] == slot[4] and slot[2] == slot[6] and len(set(slot)) == 4
    assert sorted(table.count.tolist()) == [1, 2, 2, 2]


@pytest.mark.parametrize("piece", [None, 90])
def test_buckets(monkeypatch, piece):
    if piece:
        monkeypatch.setattr(resampling, "PIECE_BYTES", piece)
    rng = random.Random(5)
    parts = ["a", "B", "ab", " ", "  ", "é", "\n", "x1", "İ", "-", "the cat", "😀", "z" * 70, "y" * 300]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(400)] + ["", "A" * 5000 + " b c"]
    data, bounds = text_bytes(pa.array(texts, pa.string()))
    for at, upto in resampling.pieces(bounds):
        part = data[bounds[at] : bounds[upto]]
        if upto == at + 1 and len(part) > resampling.PIECE_BYTES:
            words, found = resampling._long_text(part, 3, 10_000)
            assert (words, sorted(found.tolist())) == buckets_of(texts[at])
        else:
            words, counts, found = resampling.occurrences(part, bounds[at : upto + 1] - bounds[at], 3, 10_000)
            ends = np.cumsum(counts)
            for i in range(upto - at):
                assert (words[i], sorted(found[ends[i] - counts[i] : ends[i]].tolist())) == buckets_of(texts[at + i])


@pytest.mark.parametrize("rows", ["given", "awkward", "no target"])
def test_draw(spark, rows):
    if rows == "given":
        docs, target = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "benchmark"))
    else:
        # Repeats of one key have equal scores only where their texts are equal, so ranks are defined.
        docs = awkward(spark).union(awkward(spark).selectExpr("doc_id + 100", *awkward(spark).columns[1:]))
        target = spark.createDataFrame([("the w1 w2 w3",), (None,)] if rows == "awkward" else [], "text string")
    want = plain([(r["doc_id"], r["text"]) for r in docs.collect()], [r["text"] for r in target.collect()])
    assert sorted((tuple(r) for r in resampling.resample(docs, target).collect()), key=str) == want


def test_no_documents(spark):
    assert resampling.resample(empty(spark), empty(spark)).collect() == []
