"""The trie of conversations against a plain version."""

import random

import pytest

from tests.llm.plain_trie import nodes
from tidemark.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def conversations(n, ids, seed):
    rng, rows = random.Random(seed), []
    for _ in range(n):
        c = rng.choice([None, 0, 100, 7, 107, 203, 300, 5, *range(ids)])
        for turn in range(rng.randrange(9)):
            rows.append((c, rng.choice([None, turn, turn, turn]), rng.choice(["user", "assistant", None]),
                         rng.choice(["a", "b", "é", None, "", "longer text"])))
    return rows


CASES = {
    "random": conversations(200, 40, 1),
    "repeated rows": conversations(20, 10, 2) * 3,
    "deep": [(300, i, "u", str(i % 7)) for i in range(90)] + [(301, i, "u", str(i % 7)) for i in range(70)] + conversations(20, 9, 3),
    "copies": [(c, t, "user", f"turn {t}") for c in range(1000, 1600) for t in range(3)],
    "one": [(5, 0, "u", "x")],
    "no key": [(None, 0, "u", "x")],
    "none": [],
}


def found(df, **options):
    return sorted((tuple(r) for r in prefix_trie.trie(df, **options).collect()), key=lambda r: r[:2])


@pytest.mark.parametrize("case", CASES)
def test_trie(spark, monkeypatch, case):
    monkeypatch.setattr(prefix_trie, "BLOCK_TURNS", 8)
    df = spark.createDataFrame(CASES[case], SCHEMA).selectExpr("*", "1 AS depth", "'x' AS number", "2 AS a")
    assert found(df) == nodes(CASES[case])


def test_a_full_sketch_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CELL_BLOCK", 64)
    rows = CASES["random"]
    assert found(spark.createDataFrame(rows, SCHEMA), most_cells=64) == nodes(rows)


def test_long_lists_of_ends_come_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 7)
    rows = CASES["copies"]
    assert found(spark.createDataFrame(rows, SCHEMA)) == nodes(rows)


def test_only_prefixes_that_may_be_shared_are_grouped(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = prefix_trie.prefixes(prefix_trie.rebuilt_turns(prefix_trie.numbered_turns(df)))
    screened = prefix_trie.screen(rows, prefix_trie.sketch(rows))
    met = rows.groupBy("a", "b").count()
    shared = met.where("count > 1").count()
    assert screened.where("alone").join(met.where("count > 1"), ["a", "b"]).count() == 0
    assert screened.where("NOT alone").select("a", "b").distinct().count() <= shared + 0.02 * screened.count()
