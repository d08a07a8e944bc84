"""How often the survey feeds move their rows, and the registry's look-up and numbering in one pass."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.test_plans import plan_of
from tidemark.operators import numbering
from tidemark.operators.registry import KeyRegistry
from tidemark.plans.feeds import finding_maxima, key_value_feed
from tidemark.queries import QUERIES, frames
from tidemark.workspace import new_path

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_findings_are_not_moved_to_suppliers_nor_to_be_grouped(spark, no_broadcast):
    plan = plan_of(QUERIES["q_feed_key_value_natural"](spark, SF_DIR))
    assert "hashpartitioning(l_partkey" in plan and "hashpartitioning(l_suppkey" not in plan
    assert not [line for line in plan.splitlines() if "hashpartitioning(" in line and "RepairElement" in line]


@pytest.mark.parametrize("name", ["q_distinct", "q_feed_key_lookup"])
def test_parts_of_large_line_tables_are_bounded(spark, monkeypatch, name):
    plain = rows(QUERIES[name](spark, SF_DIR))
    monkeypatch.setattr(frames, "LINE_BYTES_PER_TASK", 1000)
    dealt = QUERIES[name](spark, SF_DIR)
    assert "REPARTITION_BY_NUM" in plan_of(dealt)
    assert rows(dealt) == plain


def test_numbering_moves_every_column_once(spark, monkeypatch):
    monkeypatch.setattr(numbering, "materialise", lambda df, label: df)
    df = spark.range(9).selectExpr("id % 2 AS `a.b`", "id AS n", "-id AS m")
    placed = numbering.placed_rows(df, ["n"], tie_break=["a.b"], distinct_rows=True)
    (exchange,) = [line for line in placed._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Project" in line][-1:]
    assert exchange.count(" AS ") == 3
    assert [tuple(r["row"]) for r in placed.collect()] == [(n % 2, n, -n) for n in range(9)]


def test_keys_are_looked_up_and_numbered_in_one_pass(spark):
    frame = lambda pairs: spark.createDataFrame(pairs, "a string, b long, v double")
    first = frame([("b", 1, 0.1), ("d", 1, 0.2), (None, 2, 0.3)])
    more = frame([("a", 1, 1.0), ("b", 1, 1.1), ("c", None, 1.2), (None, 2, 1.3), ("d", 1, 1.4), (None, None, 1.5)])
    registry = KeyRegistry.of(new_path(spark, "keys"), first.select("a", "b"))
    assert rows(registry.assigned(first, "n", ["a"])) == [(1, None, 2, 0.3), (2, "b", 1, 0.1), (3, "d", 1, 0.2)]
    want = rows(spark.createDataFrame(
        [(1, None, 2, 1.3), (2, "b", 1, 1.1), (3, "d", 1, 1.4), (4, None, None, 1.5), (5, "a", 1, 1.0), (6, "c", None, 1.2)],
        "n long, a string, b long, v double"))
    assert rows(registry.assigned(more, "n", ["a"])) == want
    assert rows(registry.assigned(more, "n", ["a"])) == want == rows(registry.numbered(more, "n"))
    narrow = more.withColumn("b", F.col("b").cast("int"))  # its keys hash differently
    assert [r[0] for r in rows(registry.assigned(narrow, "n", ["a"]))] == [1, 2, 3, 4, 5, 6]
    assert registry.register(more.select("a", "b")) == 0


def test_maxima_given_to_the_feed(spark):
    asset, findings = frames.survey_asset(spark, SF_DIR), frames.survey_union(spark, SF_DIR)
    make = lambda **kw: key_value_feed(
        asset, findings, as_of=frames.AS_OF, creator="c", excluded=("Supplier#000000001",), numbered=False, **kw)
    assert rows(make(maxima=finding_maxima(findings, ("Supplier#000000001",)))) == rows(make())
