"""Every operator and stage on awkward and empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.frames import awkward, empty
from tidemark.llm import decontaminate, html, langid, lm, minhash, packing, pii, quality, substrings, vectors

ITEMS = "item_id long, text string"
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (2, 0, 0), (2, 1, 0), (4, None, 0), (None, 1, 0), (7, 0, 1), (7, 0, 1)]
    return spark.createDataFrame(rows, LABELS)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(20, 40))), (2, None), (3, ""), (4, "漢字")], ITEMS)


OPERATORS = {
    "pii": lambda d, labels, items: pii.find_spans(d),
    "packing": lambda d, labels, items: packing.pack(d),
    "decontaminate": lambda d, labels, items: decontaminate.contaminated(d, items),
    "lm": lambda d, labels, items: lm.score(d),
    "minhash": lambda d, labels, items: minhash.classes(d),
    "quality": lambda d, labels, items: quality.score_documents(d, quality.train(d, labels)),
    "substrings": lambda d, labels, items: substrings.repeats(d),
    "langid": lambda d, labels, items: langid.predict_documents(d, langid.train(d)),
}
ONE_ROW_EACH = {"pii", "lm", "minhash", "quality", "langid"}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_operators(spark, labels, items, name):
    docs = awkward(spark)
    found = OPERATORS[name](docs, labels, items).collect()
    if name in ONE_ROW_EACH:
        count = lambda rows: sorted(str(r["doc_id"]) for r in rows)
        assert count(found) == count(docs.collect())
    assert OPERATORS[name](empty(spark), labels, items).collect() == []


def test_stages_keep_columns(spark, labels, items, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    for make in (awkward, empty):
        docs = make(spark)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, str(tmp_path)).schema.simpleString() == docs.schema.simpleString()
        make(spark).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        assert corpus_pipeline.run(spark, str(tmp_path)).count() >= 0


def test_texts_of_one_class_leave_one_document(spark):
    kept = [r["doc_id"] for r in minhash.deduplicate(awkward(spark)).collect()]
    assert sorted(map(str, kept)) == ["1", "3", "6", "7", "None"]  # 8 is near 1; 3, 4, 5 and a row without key have no words


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, None, 1), (5, [0.0, 0.0], 1), (6, [1.0, nan], 1),
            (7, [1.0, inf], 1), (8, [1.0, None], 1), (9, [1.0, 0.0], None), (10, [], 1), (11, [1.0, 0.0], 1), (11, [1.0, 0.0], 1),
            (12, [1.0, 0.0, 0.0], 1), (13, [1e-30, 1e-32], 1), (14, [0.98, 0.3], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("node", F.lit("x"))
    found = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vectors.link(df).collect()}
    assert found[1] == (4, 1, True) and found[2] == (4, 1, False) and found[11] == (4, 1, False) and found[13] == (4, 1, False)
    assert all(found[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 12, 14))
    assert vectors.link(df.limit(0)).collect() == []


def test_pages(spark):
    page = ("<html><head><title>t</title></head><body><nav><ul><li><a href='/'>menu</a></li></ul></nav><article><h1>Head &amp; more</h1>"
            "<p>One   two<br>three</p><script>var p='<p>no</p>';</script><p>Four<!-- not this --></p></article><footer>foot</footer></body></html>")
    rows = [(i, "u", page) for i in range(40)] + [(100, None, None), (101, "u", ""), (102, "u", "<p"), (None, "u", "<!-- open"), (1, "u", page)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x"))
    found = html.extract(df).collect()
    assert len(found) == len(rows)
    assert {r["text"] for r in found if r["page_id"] is not None and r["page_id"] < 40} == {"Head & more\nOne two three\nFour"}
    assert all(r["text"] == "" and r["n_chars"] == 0 for r in found if r["page_id"] is None or r["page_id"] in (100, 101))
    assert html.extract(df.limit(0)).collect() == []
