"""Operators against plain versions and planted cases."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.frames import words
from tests.llm.plain_pii import base_spans
from tidemark.llm import decontaminate, graph, html, langid, lm, minhash, packing, pii, quality, substrings, vectors

SF_DIR = "/root/testdata/sf0.001"
TRICKY = [
    "1 " * 3000 + "a@b.co", "9" * 5000, "a." * 500 + "@", "+1" + "(" * 3000, "x a@b.c.@x.y a@b.co%d@e.f 1.2.3.4.5.6.7.8",
    "4111 1111 1111 1111 +44 (20) 7946-0958 😀 z@y.com", "a@b.co " * 2000, "256.1.1.1 0001.2.3.004", "4111-1111-1111-1112",
    "+12 345 678", "+123456789012345678", "1 2 3 4 5 6 7 8 9 0 1 2", "", "mail: q@w.de.",
]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def test_base_spans(spark, documents):
    texts = [r["text"] for r in documents.select("text").collect()] + TRICKY
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in pii.find_spans(df).collect():
        want = ",".join(f"{k}:{s}:{e}" for s, _, e, k in base_spans(texts[row["doc_id"]]))
        assert row["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert row["spans"].split(",")[0:1] == want.split(",")[0:1] or "term" in row["spans"]


def test_words_that_give_an_entity_away(spark):
    rows = [(i, f"the patient Zyxwv wrote from zed@mail.com on day {'abcdefgh'[i]}") for i in range(8)]
    rows += [(100 + i, f"the patient wrote from home on day {i} to other{i}@mail.com") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in pii.find_spans(df).collect()}
    assert found[0].startswith("term:12:17,email:29:41") and "term" not in found[100]
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(df).collect()}
    assert clean[0] == "the patient  wrote from [EMAIL] on day a" and "[EMAIL]" in clean[101]


def test_entities_of_one_document_are_judged(spark):
    rows = [(0, "the patient Zyxwv (zed@mail.com, ann@mail.com) wrote")]
    rows += [(i, f"the patient wrote from home to other{i}@mail.com") for i in range(1, 120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["spans"] for r in pii.find_spans(df).collect()}
    assert found[0] == "term:12:17,email:19:31,email:33:45" and "term" not in found[1]
    assert {r["doc_id"]: r["text"] for r in pii.sanitise(df).collect()}[0] == "the patient  ([EMAIL], [EMAIL]) wrote"


def test_context_reaches_past_other_entities(spark):
    rows = [(i, f"Zyxwv ann@mail.com zed@mail.com wrote {'abcdefgh'[i]}") for i in range(8)]
    rows += [(100 + i, f"Zyxwv wrote ann@mail.com from home on day {i}") for i in range(60)]  # tells ann, not only zed
    rows += [(200, "Qwert ann@mail.com éx@y.de")] * 8
    found = {r["doc_id"]: r["spans"] for r in pii.find_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    near = pii.contexts(pii.find_base(spark.createDataFrame(rows[:1], "doc_id long, text string")))
    assert {(r["start"], r["end"]) for r in near.groupBy("start", "end").count().where("count = 2").collect()} == {(0, 5), (32, 37), (38, 39)}
    assert "term:0:5" in found[200]


def test_packing(spark, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_vocabulary())
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    rows = packing.pack(documents).collect()
    pieces, places = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for key, text in texts.items():
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        for number, r in enumerate(sorted(pieces[key], key=lambda r: r["piece"])):
            part = ids[number * 4096 : (number + 1) * 4096]
            assert (r["piece"], r["start"], r["length"]) == (number, number * 4096, len(part))
            assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
    for place in places.values():
        at = 0
        for offset, length in sorted(place):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(places) <= 1.02 * sum(r["length"] for r in rows) / 4096 + 1


def test_open_bins_close_the_fullest_first():
    bins = packing.OpenBins(10, 2)
    assert bins.place(6) == (0, 0) and bins.place(7) == (1, 0)
    assert bins.place(8) == (2, 0)  # bin 1, the fullest, is closed
    assert bins.place(3) == (0, 6) and bins.place(2) == (2, 8)


def test_reordered_passages_are_found(spark):
    item = words(0, 40)
    parts = [words(20, 20), words(500, 30), words(0, 20)]
    rows = [(1, " ".join(parts)), (2, words(1000, 100)), (3, f"x {item.upper()}! y"), (4, words(0, 12)), (5, words(0, 24))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (8, "tiny item")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): (r["coverage"], r["tiles"]) for r in decontaminate.contaminated(docs, bench).collect()}
    assert found == {(1, 7): (1.0, 2), (3, 7): (1.0, 1), (5, 7): (0.6, 1)}
    assert sorted(r["doc_id"] for r in decontaminate.remove_contaminated(docs, bench).collect()) == [2, 4]


def test_blocks_of_the_benchmark_give_the_same(spark, documents):
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    one = next(decontaminate.blocks(bench))
    many = list(decontaminate.blocks(bench, 500))
    assert len(many) > 5 and sorted(k for b in many for k, _ in b) == sorted(k for k, _ in one)


def test_scores(spark, documents):
    rows = documents.select("doc_id", "text").collect()
    tokens = {r["doc_id"]: r["text"].encode().lower().split() + [b""] for r in rows}
    out = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in tokens}
    counts = Counter(t for k, ts in tokens.items() if not out[k] for t in ts)
    n, v = sum(counts.values()), len(counts)
    found = lm.score(documents).collect()
    for r in found:
        ts = tokens[r["doc_id"]]
        assert r["held_out"] == out[r["doc_id"]] and r["n_tokens"] == len(ts) and r["train_tokens"] == n
        assert r["n_known"] == sum(t in counts for t in ts)
        assert r["base_score"] == pytest.approx(sum(np.log10((counts[t] + 1) / (n + v + 1)) for t in ts), rel=1e-9)
    held = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_model_is_normalised():
    model = lm.LogBilinear(np.full(9, 1 / 9))
    first, second = model.tables()
    scores = first[2, :8] + second[5, :8]
    assert np.exp(scores - np.log(np.exp(scores).sum())).sum() == pytest.approx(1.0)


def _jaccard(a, b):
    sets = []
    for text in (a, b):
        w = text.lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_near_duplicates(spark):
    draw = random.Random(3)
    base = [f"t{draw.randrange(5000)}" for _ in range(200)]
    texts = [" ".join(base)]
    for i in range(700):  # a group larger than a chunk whose members are near the first and not all near each other
        copy = list(base)
        for _ in range(3):
            copy[draw.randrange(200)] = f"u{i}"
        texts.append(" ".join(copy))
    texts += [" ".join(f"v{draw.randrange(10**6)}" for _ in range(100)) for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["class_id"] for r in minhash.classes(df).collect()}
    assert all(found[i] == i for i in range(701, 731))
    near = [i for i in range(701) if _jaccard(texts[0], texts[i]) >= 0.84]
    assert len(near) > 600 and all(found[i] == 0 for i in near)


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    found = {r["id"]: r["component"] for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 1 for i in range(1, 61)}, **{i: 100 for i in range(100, 140)}}


def test_quality_and_language_hold_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = quality.score_documents(docs, quality.train(docs, labels)).where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in scored]) > 0.95
    known = docs.select("doc_id", "lang")
    named = langid.predict_documents(docs, langid.train(docs)).where("held_out").join(known, "doc_id").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in named]) > 0.95


def test_suffix_automaton_takes_longest_matches():
    text = "abcabdxyz"
    automaton = langid.SuffixAutomaton(text)
    for query in ("abcabd", "abdabc", "xyzq", "qq", "cabx", ""):
        want, at = 0, 0
        while at < len(query):
            n = max((n for n in range(1, len(query) - at + 1) if query[at : at + n] in text), default=1)
            want, at = want + 1, at + n
        assert automaton.phrases(query) == want


def test_compact_windows():
    draw = np.random.default_rng(0)
    for _ in range(100):
        n, run = int(draw.integers(1, 60)), int(draw.integers(1, 12))
        v = draw.permutation(1000)[:n].astype(np.uint64)
        want = set()
        for left in range(n - run + 1):
            for right in range(left + run - 1, n):
                c = a = b = left + int(v[left : right + 1].argmin())
                while a > 0 and v[a - 1] > v[c]:
                    a -= 1
                while b < n - 1 and v[b + 1] > v[c]:
                    b += 1
                want.add((a, c, b))
        found = substrings.compact_windows(v[None, :], run)[0]
        assert set(found) == want and len(found) == len(want)


def test_repeated_passages(spark):
    passage = words(0, 60)
    rows = [(i, f"{words(10_000 * (i + 1), 70)} {passage} {words(10_000 * (i + 1) + 500, 40)}") for i in range(5)]
    rows += [(10, words(900_000, 200)), (11, words(900_300, 45)), (12, words(900_300, 45)), (13, passage), (14, passage)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = substrings.repeats(df).collect()
    named = {r["doc_id"] for r in found} | {r["other_doc_id"] for r in found}
    assert named == {0, 1, 2, 3, 4, 13, 14}
    for r in found:
        if r["doc_id"] < 5:
            assert (r["start_word"], r["end_word"]) == (70, 130)


def test_passages_with_a_hot_line_inside(spark):
    line, rows = words(0, 30), []
    for i in range(60):
        n = 10_000 * (i // 2 + 1)  # two documents share twenty words around the line that all hold
        own = 1_000_000 + 1_000 * i
        rows.append((i, f"{words(own, 60)} {words(n, 10)} {line} {words(n + 10, 10)} {words(own + 100, 60)}"))
    found = substrings.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    places = {frozenset((r["doc_id"], r["other_doc_id"])): (r["start_word"], r["end_word"]) for r in found}
    assert places == {frozenset((i, i + 1)): (60, 110) for i in range(0, 60, 2)}


def test_passages_whose_parts_stand_earlier_too(spark):
    passage = words(0, 60)
    rows = [(1, f"{words(0, 30)} {words(1000, 70)} {passage} {words(2000, 40)}"), (2, f"{words(3000, 50)} {passage} {words(4000, 40)}")]
    found = substrings.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    place = {1: (100, 160), 2: (50, 110)}
    assert found
    for r in found:
        assert (r["start_word"], r["end_word"]) == place[r["doc_id"]]
        assert (r["other_start_word"], r["other_end_word"]) == place[r["other_doc_id"]]


def test_common_runs_at_every_place():
    draw = np.random.default_rng(2)
    line, passage = (draw.integers(0, 2**60, n, dtype=np.uint64) for n in (20, 60))
    mixed = lambda n: draw.integers(0, 2**60, n, dtype=np.uint64)
    a = np.concatenate([line, mixed(30), passage[:30], mixed(40), line, line, passage, mixed(9)])
    b = np.concatenate([mixed(25), passage, mixed(50), line])
    assert substrings.common_runs(a, b, 46, 0.8) == [(160, 220, 25, 85)]
    assert substrings.common_runs(np.full(9000, 7, np.uint64), np.full(700, 7, np.uint64), 46, 0.8)[0][2:] == (0, 700)
    assert substrings.common_runs(a[:0], b, 46, 0.8) == [] == substrings.common_runs(a, b[:45], 46, 0.8)


def test_vector_links(spark):
    draw = np.random.default_rng(1)
    centre = draw.normal(size=(40, 32))
    x = (centre[draw.integers(0, 40, 1500)] + 0.11 * draw.normal(size=(1500, 32))).astype(np.float32)
    label = draw.integers(0, 2, 1500)
    df = spark.createDataFrame(
        [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, label))], "vec_id long, embedding array<float>, label int")
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    near = (u @ u.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(near, False)
    found = {r["vec_id"]: r["n_links"] for r in vectors.link(df).collect()}
    assert near.sum() > 1000 and [found[i] for i in range(1500)] == near.sum(axis=1).tolist()


def test_page_blocks_and_their_words():
    texts = lambda page: [b[0] for b in html.blocks(page)]
    assert texts("<p>one <svg width='1'/> two</p><p>three</p>") == ["one two", "three"]
    assert texts("<p>one <svg><path d='M1'/>no</svg>two</p>") == ["one two"]
    assert texts("<p>as <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>TeX</annotation></math> is</p><math/><p>on</p>") == ["as x=2 is", "on"]
    page = lambda text: html.Featuriser().page([(text, html.ROOT.then("p"), 0)])
    assert (page("cookie") != page("cinema")).any() and (page("Cookie,")[0, :-4] == page("cookie")[0, :-4]).all()


def test_whole_pages_are_learned_from():
    page = "<article>" + "<p>text</p>" * 300 + "</article><footer>foot</footer>"
    batch = pa.RecordBatch.from_pydict({"html": [page], "place": [1]})
    lengths = [len(y) for out in html._examples([batch]) for y in out.column("y").to_pylist()]
    assert lengths[:3] == [120, 120, 61]


def test_repeated_rows_of_a_sampled_key_are_learned_once(spark, documents):
    docs = documents.select("doc_id", "text").limit(60)
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    key = docs.where(quality.trainable(F.col("doc_id"), quality.FOLDS, quality.HELD_OUT_FOLD)).agg(F.min("doc_id")).first()[0]
    hot = docs.unionByName(docs.where(F.col("doc_id") == key).crossJoin(spark.range(200)).select("doc_id", "text"))
    assert (quality.train(hot, labels) == quality.train(docs, labels)).all()
