"""Personal data: base patterns, and information-theoretic sanitisation of the words around them.

Base spans are emails, IP addresses, card numbers (Luhn) and phone numbers: per kind the leftmost matches that do not
overlap, of which failing ones are dropped. Every value found is a protected entity.

A word near an entity can give it away. Over all documents the corpus tells in how many an entity occurs (n_e), in how
many a word occurs (n_t), and in how many the word stands within `CONTEXT_CHARS` of the entity (n_et). The pointwise
mutual information log2(n_et N / (n_e n_t)) says how much of the entity's information content log2(N / n_e) the word
reveals. As chance brings rare words and rare entities together too, n_et / n_t, how surely the word tells the entity, is
smoothed: `prior` documents more hold the word, and the entity as often as documents do at large. So entities and words of
one or two documents are judged like all others. Words that reveal at least the share `disclosure` become spans of kind
`term`. Sanitising replaces base spans by the name of their kind, generalises such words to `[TERM]`, and
removes those that stand nowhere but near the entity, which reveal it completely. Context is taken from the text whatever
other entities stand in it; the letters of emails are no words. Documents without an entity are left as they are.

Everything is built from DataFrame functions. Positions are code points: a pattern's matches and the texts between them
alternate, so the running totals of their lengths are the positions. The patterns start a match only where one can
start and never give back what they took, which keeps them linear on very long texts.

Defined results: a NULL text counts as empty and stays NULL when sanitised. Repeated rows give equal results, and each
counts in the statistics. Rows without a key are handled like others. An empty table gives no rows. Columns of the
table with any other name are kept apart and never mixed up with the operator's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.workspace import materialise

KINDS = ("email", "ip", "card", "phone", "term")
BASE_KINDS = KINDS[:4]
# An attempt starts at the left end of a run of its letters, or where the last match ended (\G). Starting further right
# could only fail likewise.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for a pattern to be tried at all.
SIGNS = {"email": "@", "phone": "+"}
WORD = r"\p{L}+"
CONTEXT_CHARS = 80
PRIOR = 0.5
DISCLOSURE = 0.9
BLOCK = 256


def running_totals(steps: Column) -> Column:
    """The running totals of an array of numbers, block by block, so that the work is far below its square."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.ceil(F.size(steps) / F.lit(BLOCK)).cast("int") - 1),
        lambda b: F.slice(steps, b * BLOCK + 1, F.lit(BLOCK)))
    within = F.transform(blocks, lambda block: F.transform(block, lambda _, i: _total(F.slice(block, F.lit(1), i + 1))))
    before = F.aggregate(
        within, F.array(F.lit(0).cast("long")), lambda done, block: F.array_append(done, F.element_at(done, -1) + F.element_at(block, -1)))
    totals = F.flatten(F.zip_with(
        within, F.slice(before, F.lit(1), F.size(within)), lambda block, start: F.transform(block, lambda x: x + start)))
    return F.when(F.size(steps) > 0, totals).otherwise(F.array().cast("array<bigint>"))


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, b: a + b)


def with_matches(df: DataFrame, name: str, text: str, pattern: str, where: Column) -> DataFrame:
    """Adds the matches of a pattern, the texts between them, and where each match starts, as `name_m`, `_g`, `_s`."""
    m, g = f"{name}_m", f"{name}_g"
    empty = F.array().cast("array<string>")
    df = df.withColumns({
        m: F.when(where, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(empty),
        g: F.when(where, F.split(text, pattern, -1)).otherwise(empty),
    })
    steps = F.transform(
        F.col(m), lambda _, i: (F.length(F.get(F.col(g), i)) + F.coalesce(F.length(F.get(F.col(m), i - 1)), F.lit(0))).cast("long"))
    df = df.withColumn(f"{name}_s", steps)
    return df.withColumn(f"{name}_s", running_totals(F.col(f"{name}_s")))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def weight(i):
        digit = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(i % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + weight(i)) % 10 == 0


def _part_is_byte(part: Column) -> Column:
    rest = F.ltrim(part, F.lit("0"))
    return (F.length(rest) < 3) | ((F.length(rest) == 3) & (rest <= "255"))


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), _part_is_byte)
    if kind == "card":
        n = F.length(_digits(value))
        return F.when((n >= 12) & (n <= 19), _luhn(_digits(value))).otherwise(F.lit(False))
    if kind == "phone":
        n = F.length(_digits(value))
        return (n >= 9) & (n <= 15)
    return F.lit(True)


def _span(kind: str, start: Column, end: Column) -> Column:
    return F.struct(
        start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"))


def _without_emails(text: Column) -> Column:
    """The text with blanks in place of its emails, from the columns that `with_matches` added; places stay as they are."""
    blank = lambda gap, match: F.concat(gap, F.repeat(F.lit(" "), F.coalesce(F.length(match), F.lit(0))))
    return F.when(F.size("email_m") > 0, F.array_join(F.zip_with("email_g", "email_m", blank), "")).otherwise(text)


def _entities(kind: str) -> Column:
    """The valid matches of a kind, from the columns that `with_matches` added."""
    starts, words = F.col(f"{kind}_s"), F.col("words")
    more = CONTEXT_CHARS + 1  # a character more than the context tells whether a word is cut

    def entity(value, i):
        start = F.get(starts, i)
        end = start + F.length(value)
        first = F.greatest(start - more, F.lit(0))
        return F.struct(
            _span(kind, start, end).alias("span"), value.alias("value"),
            F.xxhash64(F.lit(kind), F.lower(value)).alias("entity"),
            F.substring(words, (first + 1).cast("int"), (start - first).cast("int")).alias("before"),
            F.substring(words, (end + 1).cast("int"), F.lit(more)).alias("after"))

    return F.filter(F.transform(f"{kind}_m", entity), lambda e: _valid(kind, e["value"]))


def with_spans(rows: DataFrame, text: str = "text") -> DataFrame:
    """Adds `base`, the valid spans by start and kind, and `entities`, each with the texts on its two sides."""
    text_column = F.col(text)
    kept = rows.columns
    for kind in BASE_KINDS:
        where = F.contains(text_column, F.lit(SIGNS[kind])) if kind in SIGNS else text_column.rlike("[0-9]")
        rows = with_matches(rows, kind, text, PATTERNS[kind], where)
    rows = rows.withColumn("words", _without_emails(text_column))
    entities = [_entities(kind) for kind in BASE_KINDS]
    rows = rows.withColumn("entities", F.concat(*entities))
    return rows.select(
        *kept, F.array_sort(F.transform("entities", lambda e: e["span"])).alias("base"), "entities")


def _keyed(docs: DataFrame) -> DataFrame:
    """Key and text; the key is the document's key with a digest of its text, so equal keys have equal texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(text).alias("digest"), text.alias("text"))


def find_base(docs: DataFrame) -> DataFrame:
    """One row per document with its base spans and entities, written once as it is read several times."""
    found = with_spans(_keyed(docs)).select("doc_id", "digest", "base", "entities")
    return materialise(found, "entities")


def contexts(found: DataFrame) -> DataFrame:
    """One row per entity occurrence and word near it: the document's key, the entity, the word and its place."""
    rows = found.select("doc_id", "digest", F.explode("entities").alias("e"))
    out = []
    for side in ("before", "after"):
        side_rows = rows.withColumn("side", F.coalesce(F.col(f"e.{side}"), F.lit("")))
        located = with_matches(side_rows, "w", "side", WORD, F.lit(True)).withColumn(
            "w", F.arrays_zip(F.col("w_m").alias("word"), F.col("w_s").alias("at")))
        located = located.select("doc_id", "digest", "e", F.length("side").alias("n"), F.explode("w").alias("w"))
        at, word = F.col("w.at"), F.col("w.word")
        if side == "before":
            located = located.where((F.col("n") <= CONTEXT_CHARS) | (at > 0))  # else the word may be cut
            start = F.col("e.span.start") - F.col("n") + at
        else:
            located = located.where((F.col("n") <= CONTEXT_CHARS) | (at + F.length(word) < F.col("n")))
            start = F.col("e.span.end") + at
        out.append(located.select(
            "doc_id", "digest", F.col("e.entity").alias("entity"), F.xxhash64(F.lower(word)).alias("term"),
            start.alias("start"), (start + F.length(word)).alias("end")))
    return out[0].union(out[1])


def disclosing(docs: DataFrame, found: DataFrame, near: DataFrame, prior: float, disclosure: float) -> DataFrame:
    """entity, term, share of the entity's information that the term reveals, and whether it does so completely, where that is too much."""
    n = found.count()
    by_document = near.groupBy("doc_id", "digest", "entity", "term").agg(F.lit(1).alias("one"))
    # Repeated rows of one document count as often as they occur.
    times = found.where(F.size("entities") > 0).groupBy("doc_id", "digest").agg(F.count("*").alias("times"))
    same = F.col("doc_id").eqNullSafe(F.col("t_doc_id")) & (F.col("digest") == F.col("t_digest"))
    counted = by_document.join(times.withColumnsRenamed({"doc_id": "t_doc_id", "digest": "t_digest"}), same)
    pairs = counted.groupBy("entity", "term").agg(F.sum("times").alias("n_et"))
    entities = (
        found.select(F.explode(F.array_distinct(F.transform("entities", lambda e: e["entity"]))).alias("entity"))
        .groupBy("entity").agg(F.count("*").alias("n_e")))
    text = F.coalesce("text", F.lit(""))
    outside = F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, PATTERNS["email"], " ")).otherwise(text)
    words = F.array_distinct(F.regexp_extract_all(F.lower(outside), F.lit(WORD), F.lit(0)))
    terms = (
        docs.select(F.explode(words).alias("word")).select(F.xxhash64("word").alias("term"))
        .groupBy("term").agg(F.count("*").alias("n_t")))
    information = F.log2(F.lit(float(n)) / F.col("n_e"))
    # The share is 1 for a word that always tells the entity, and 0 for one that tells it no better than chance.
    told = (F.col("n_et") + F.lit(float(prior)) * F.col("n_e") / F.lit(float(n))) / (F.col("n_t") + F.lit(float(prior)))
    share = F.when(information > 0, 1 + F.log2(told) / information).otherwise(F.lit(0.0))
    whole = (information > 0) & (F.col("n_et") >= F.col("n_t"))
    judged = pairs.join(entities, "entity").join(terms, "term").select("entity", "term", share.alias("share"), whole.alias("whole"))
    return judged.where(F.col("share") >= disclosure)


def term_spans(docs: DataFrame, found: DataFrame, prior: float = PRIOR, disclosure: float = DISCLOSURE) -> DataFrame:
    """Per document key, the spans of disclosing words, and for each whether it reveals an entity completely."""
    near = materialise(contexts(found), "contexts")
    too_much = disclosing(docs, found, near, prior, disclosure)
    hits = near.join(too_much, ["entity", "term"]).groupBy("doc_id", "digest", "start", "end").agg(F.max("whole").alias("whole"))
    term = F.struct(
        _span("term", F.col("start"), F.col("end")).alias("span"), F.col("whole"))
    # A document's spans are part of a row that is smaller than the document.
    return hits.groupBy("doc_id", "digest").agg(F.array_sort(F.collect_list(term)).alias("terms"))


def _join_terms(rows: DataFrame, terms: DataFrame) -> DataFrame:
    terms = terms.withColumnsRenamed({"doc_id": "t_doc_id", "digest": "t_digest"})
    same = F.col("doc_id").eqNullSafe(F.col("t_doc_id")) & (F.col("digest") == F.col("t_digest"))
    return rows.join(terms, same, "left").drop("t_doc_id", "t_digest")


def _as_text(spans: Column) -> Column:
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def find_spans(docs: DataFrame, prior: float = PRIOR, disclosure: float = DISCLOSURE) -> DataFrame:
    """Per document: counts of the base kinds, a digest of the base spans, and all spans as text."""
    found = find_base(docs)
    rows = _join_terms(found, term_spans(docs, found, prior, disclosure))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    extra = F.coalesce(F.transform("terms", lambda t: t["span"]), F.slice("base", 1, 0))
    return rows.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(_as_text(F.col("base")), 256).alias("base_sha256"),
        _as_text(F.array_sort(F.concat("base", extra))).alias("spans"))


def sanitise(docs: DataFrame, prior: float = PRIOR, disclosure: float = DISCLOSURE) -> DataFrame:
    """The documents with base spans and disclosing words replaced; `n_chars`, where there is one, follows the text."""
    found = find_base(docs)
    terms = materialise(term_spans(docs, found, prior, disclosure), "terms")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.md5(text).alias("digest"), text.alias("text"))
    rows = _join_terms(with_spans(rows), terms)
    parts = F.concat(
        F.transform("base", lambda s: F.struct(s.alias("span"), F.lit(False).alias("whole"))),
        F.coalesce("terms", F.array().cast("array<struct<span:struct<start:bigint,rank:int,end:bigint,kind:string>,whole:boolean>>")))
    rows = rows.select("row", "text", F.array_sort(parts).alias("parts"))
    clean = F.when(F.size("parts") == 0, F.col("row.text")).otherwise(_replaced(F.col("text"), F.col("parts")))
    rows = rows.select("row", clean.alias("clean"))
    changed = {"text": F.col("clean"), "n_chars": F.length("clean")}
    return rows.select(*[
        changed[f.name].cast(f.dataType).alias(f.name) if f.name in changed else F.col("row").getField(f.name).alias(f.name)
        for f in docs.schema.fields])


def _replaced(text: Column, parts: Column) -> Column:
    """`text` with every span replaced; spans that overlap an earlier one are swallowed by it."""
    label = lambda p: F.when(p["whole"], F.lit("")).otherwise(F.concat(F.lit("["), F.upper(p["span"]["kind"]), F.lit("]")))

    def step(done, part):
        start, end = part["span"]["start"], part["span"]["end"]
        piece = F.concat(F.substring(text, (done["at"] + 1).cast("int"), (start - done["at"]).cast("int")), label(part))
        return F.struct(
            F.greatest(done["at"], end).alias("at"),
            F.when(start >= done["at"], F.array_append(done["out"], piece)).otherwise(done["out"]).alias("out"))

    first = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    return F.aggregate(parts, first, step, lambda done: F.concat(
        F.array_join(done["out"], ""), F.substring(text, (done["at"] + 1).cast("int"), F.length(text))))
