"""Small tables with the awkward cases: NULLs, empty and long texts, repeats, and columns with names the operators use."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, `row` string, clean string, digest string, score double"


def words(start, n):
    return " ".join(f"w{i}" for i in range(start, start + n))


def awkward(spark):
    rows = [
        (1, words(0, 80)), (2, words(0, 80)), (2, words(0, 80)), (3, None), (4, ""), (5, "  \n\t "), (None, "no key at all"),
        (None, None), (6, "é ß 漢字 😀 . ! <|endoftext|> it's"), (7, "long " * 30_000), (8, words(0, 79) + " w999"),
    ]
    return spark.createDataFrame([(k, t, "en", "s", len(t or ""), "r", "c", "d", 0.5) for k, t in rows], DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)
