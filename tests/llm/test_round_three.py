"""Repeated vec_ids, shards without rows, and letters whose lower case is two characters."""

import random

import numpy as np

from tidemark.llm import packing, quality, vectors


def test_rows_with_one_vec_id_are_vectors_of_their_own(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (1, [1.0, 0.0], 2), (1, [0.0, 1.0], 2), (2, [1.0, 0.0], 1), (3, [0.0, 1.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = sorted(tuple(r) for r in vectors.link(df).collect())
    assert found == [(1, 0, 1, True), (1, 0, 1, True), (1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False)]


def test_components_are_named_by_the_smallest_vec_id(spark):
    draw = np.random.default_rng(4)
    rows = []
    for group in range(30):
        centre = draw.normal(size=16)
        rows += [(int(i), (centre + draw.normal(size=16) * 0.05).tolist(), group % 3) for i in draw.integers(0, 10**9, 8)]
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = (x @ x.T >= 0.98) & (np.array([r[2] for r in rows])[:, None] == np.array([r[2] for r in rows]))
    name = np.array([r[0] for r in rows])
    while True:
        lower = np.where(linked, name, 10**10).min(axis=1)
        if (lower == name).all():
            break
        name = lower
    want = sorted((r[0], int(n) - 1, int(c), r[0] == c) for r, n, c in zip(rows, linked.sum(axis=1), name))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(7)
    assert sorted(tuple(r) for r in vectors.link(df).collect()) == want


def test_the_mean_is_over_the_shards_that_have_rows(spark, monkeypatch):
    docs = spark.createDataFrame([(k, "good words here" if k % 2 else "bad stuff there") for k in range(40)], "doc_id long, text string")
    kept = docs.where(quality.trainable(docs.doc_id, quality.FOLDS, quality.HELD_OUT_FOLD)).orderBy("doc_id").limit(3).collect()
    labels = [spark.createDataFrame([(r["doc_id"], r["doc_id"] % 2)], "doc_id long, quality int") for r in kept]
    monkeypatch.setattr(quality, "SHARDS", 1 << 20)  # every row has a shard of its own
    alone = [quality.train(docs, one) for one in labels]
    together = quality.train(docs, labels[0].union(labels[1]).union(labels[2]))
    assert all(w.any() for w in alone)
    np.testing.assert_allclose(together, np.mean(alone, axis=0), rtol=1e-5, atol=1e-7)


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert not quality.train(docs, labels).any()


def test_unit_ids_are_those_of_the_whole_text():
    units = packing.UnitIds(packing.default_vocabulary())
    rng = random.Random(11)
    parts = ["a", "B", "İ", "ı", "į", "É", "ß", "é", "̇", ",", ".", ".,", " ", "\n", " ", "'s", "9", "-", "ŉ", "ǰ", "ɏ", "字", "😀", "word"]
    texts = ["Abİ,", "İİ.", "İ a,b. İ", "İstanbul, Iİ."] + ["".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(20000)]
    whole = units.tokenizer.encode_batch(texts, add_special_tokens=False)
    wrong = [t for t, w in zip(texts, whole) if units.encode(t) != np.array(w.ids, "<u4").tobytes()]
    assert wrong == []
