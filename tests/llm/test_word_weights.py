"""Near duplicates whose similarity hangs on the frequencies of words that few documents hold."""

import random
from collections import Counter

import numpy as np

from tidemark.llm import minhash


def _texts():
    """Texts 2k and 2k + 1 differ in words of another frequency than those they share, about as much as copies may."""
    draw, texts = random.Random(5), []
    for k in range(60):
        common, seldom = (lambda: f"c{draw.randrange(40)}"), (lambda: f"s{draw.randrange(1500)}")
        shared, own = (common, seldom) if k % 2 else (seldom, common)
        base = [shared() for _ in range(92 + k // 3)]
        for _ in range(2):
            copy = [own() for _ in range(6)] + base[6:-5] + [own() for _ in range(5)]
            texts.append(" ".join(copy))
    return texts


def _weights(text, counts, total):
    words = text.split()
    weight = {w: 1 + minhash.RARITY * np.log1p(total / counts[w]) / np.log1p(total) for w in words}
    out = Counter()
    for i in range(len(words) - minhash.SHINGLE + 1):
        shingle = tuple(words[i : i + minhash.SHINGLE])
        out[shingle] += float(np.round(sum(weight[w] for w in shingle) / minhash.SHINGLE, 3))
    return out


def _pairs_by_plain_weights(texts):
    counts = Counter(w for t in texts for w in set(t.split()))
    held = [_weights(t, counts, len(texts)) for t in texts]
    alike = lambda a, b: sum((a & b).values()) / sum((a | b).values())
    return [alike(held[i], held[i + 1]) for i in range(0, len(texts), 2)]


def test_words_beyond_the_most_frequent_keep_their_weight(spark, monkeypatch):
    texts = _texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = _pairs_by_plain_weights(texts)
    assert sum(abs(s - minhash.SIMILARITY) < 0.02 for s in want) > 15
    for most in (0, 10, 45, 65_536):
        monkeypatch.setattr(minhash, "FREQUENT_WORDS", most)
        found = {r["doc_id"]: r["class_id"] for r in minhash.classes(docs).collect()}
        for k, similarity in enumerate(want):
            if abs(similarity - minhash.SIMILARITY) > 1e-4:
                assert (found[2 * k] == found[2 * k + 1]) == (similarity > minhash.SIMILARITY), (most, k, similarity)
