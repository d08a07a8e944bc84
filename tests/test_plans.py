"""Physical plans: no nested loops, no single-task stages over rows, hot keys split, scans pruned."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from tidemark.queries import QUERIES
from tidemark.operators.membership import rows_in
from tidemark.operators.numbering import global_row_number, placed_rows
from tidemark.operators.versions import hash_anti_join, latest_per_key, mark_new
from tidemark.plans.feeds import communications_feed, key_value_feed, survey_findings
from tidemark.plans.load import incremental_rows
from tidemark.workspace import materialise

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    """The final adaptive plan, after running the query."""
    df._jdf.collectToPython()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def skew_settings(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def hot(column, other, share=3):
    """A third of the rows share one value."""
    return F.when(F.col("id") % share == 0, F.lit(0)).otherwise(other).alias(column)


def _batch(rows):
    return rows.select(
        "id",
        F.md5(hot("h", F.col("id")).cast("string")).alias("HASH_VALUE"),
        F.sha2(F.col("id").cast("string"), 512).alias("payload"),
    )


def test_hot_hash_is_split_in_anti_join(spark, skew_settings):
    rows = spark.range(0, 60_000, 1, 8)
    batch = _batch(rows)
    latest = spark.range(30_000, 90_000, 1, 8).select(F.md5(F.col("id").cast("string")).alias("HASH_VALUE"))
    kept = hash_anti_join(batch, latest)
    plan = plan_of(kept)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "SortMergeJoin(skew=true)" in plan
    expected = [i for i in range(60_000) if i % 3 == 0 or i < 30_000]
    assert kept.count() == len(expected)


def test_hot_hash_is_split_when_marking(spark, skew_settings):
    rows = spark.range(0, 60_000, 1, 8)
    batch = _batch(rows)
    latest = spark.range(30_000, 90_000, 1, 8).select(F.md5(F.col("id").cast("string")).alias("HASH_VALUE"))
    marked = mark_new(batch, latest)
    assert "SortMergeJoin(skew=true)" in plan_of(marked)
    assert marked.where("is_new").count() == hash_anti_join(batch, latest).count()


def test_hot_key_in_one_load_is_split(spark, skew_settings):
    history = materialise(spark.range(0, 60_000, 1, 8).select(
        hot("k", F.col("id")), F.lit(1).cast("bigint").alias("B_LOADID"), F.sha2(F.col("id").cast("string"), 512).alias("h")
    ), "history")
    latest = latest_per_key(history, "k")
    plan = plan_of(latest)
    assert "SortMergeJoin(skew=true)" in plan
    assert "Window" not in plan
    assert latest.count() == 60_000


def test_versions_of_a_hot_key_spread_over_tasks(spark, skew_settings):
    history = spark.range(0, 60_000, 1, 8).select(hot("k", F.col("id")), F.col("id").alias("B_LOADID"))
    plan = plan_of(latest_per_key(history, "k"))
    assert "hashpartitioning(k#" in plan and "B_LOADID" in plan
    assert latest_per_key(history, "k").where("k = 0").count() == 1


def test_row_number_has_no_single_task_stage_over_rows(spark):
    rows = spark.range(0, 10_000, 1, 8).select(hot("k", F.col("id")), "id")
    numbered = global_row_number(rows, ["k"], "n")
    plan = plan_of(numbered)
    # One single-partition exchange remains: the partition sizes, one row each.
    assert plan.count("Exchange SinglePartition") <= 2
    assert "BroadcastHashJoin" in plan
    assert [r["n"] for r in numbered.orderBy("n").collect()] == list(range(1, 10_001))
    plain = spark.range(0, 10_000).select(hot("k", F.col("id")), "id").orderBy("k", "id").collect()
    assert [(r["k"], r["id"]) for r in numbered.orderBy("n").collect()] == [(r["k"], r["id"]) for r in plain]


def _sort_partitions(placed):
    return placed.select(F.shiftright("place", 33).alias("p")).groupBy("p").count().collect()


@pytest.mark.parametrize("what", ["leading value", "copies"])
def test_row_number_spreads_hot_ties(spark, what):
    ids = spark.range(0, 40_000, 1, 8)
    rows = ids.select(hot("k", F.col("id")), "id") if what == "leading value" else ids.select(hot("k", F.col("id")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = placed_rows(rows, ["k"], distinct_rows=what == "leading value")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(_sort_partitions(placed.where("row.k = 0"))) > 1
    assert max(r["count"] for r in _sort_partitions(placed)) < 40_000 / 3


def test_load_reads_only_key_load_and_hash_of_the_target(spark, tmp_path):
    path = str(tmp_path / "target")
    spark.range(100).selectExpr(
        "1L AS B_LOADID", "id AS ID", "md5(string(id)) AS HASH_VALUE", "repeat('x', 100) AS payload"
    ).write.parquet(path)
    batch = spark.range(50, 150).selectExpr("id AS ID", "md5(string(id)) AS HASH_VALUE")
    fresh = incremental_rows(batch, spark.read.parquet(path), keys="ID", load_id=2)
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "payload" not in plan
    assert "PushedFilters: [IsNotNull(ID), IsNotNull(B_LOADID)]" in plan
    assert fresh.count() == 50


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(spark, name):
    plan = spark_entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert bad not in plan


def test_hot_asset_is_reduced_before_the_join(spark, skew_settings):
    ids = spark.range(0, 60_000, 1, 8)
    attributes = ids.select(
        hot("AssetID", F.col("id")), (F.col("id") % 50).alias("RepairElementID"), F.lit("E").alias("RepairElement"),
        (F.col("id") % 10).alias("ComponentID"), F.lit("C").alias("Component"), F.lit(1).alias("AttributeID"),
        F.col("id").alias("SurveyAttributeID"), F.lit("x").alias("Attribute"),
        F.lit("2020-01-01").cast("timestamp_ntz").alias("InstallationDate"), F.lit("s").alias("Surveyor"),
    )
    repairs = spark.createDataFrame([], "AssetID long, RepairElement string, ComponentID long, Component string, "
                                        "RepairID int, SurveyRepairID long, RepairDescription string, Quantity int, "
                                        "YearDue int, RepairCost double, Surveyor string")
    asset = ids.select(F.col("id").alias("AssetID"), F.col("id").cast("string").alias("UPRN"))
    feed = key_value_feed(asset, survey_findings(attributes, repairs), as_of="2020-01-01", creator="t", numbered=False)
    plan = feed._jdf.queryExecution().executedPlan().toString()
    join, partial, final = plan.index("SortMergeJoin"), plan.index("partial_max"), plan.index("functions=[max")
    assert join < final < partial, "the maxima are computed below the join"
    assert feed.count() == 40_000 + 10


def test_contacts_join_once_and_a_hot_party_is_split(spark, skew_settings):
    ids = materialise(spark.range(0, 60_000, 1, 8), "ids")
    contacts = ids.select(
        F.col("id").alias("cde_refno"), hot("cde_par_refno", F.col("id")),
        F.sha2(F.col("id").cast("string"), 512).alias("cde_contact_value"), F.lit("n").alias("cde_contact_name"),
        F.lit("1").alias("cde_precedence"), F.lit("EMAIL").alias("cde_frv_cme_code"),
    )
    parties = ids.select(F.col("id").alias("par_refno"))
    current = ids.select(F.col("id").alias("party"))
    feed = communications_feed(contacts, parties, current, as_of="2020-01-01", creator="t")
    assert "SortMergeJoin(skew=true)" in plan_of(feed)
    assert feed.count() == 60_000


@pytest.mark.parametrize("hot_side", ["left", "right"])
def test_hot_value_in_semi_join(spark, skew_settings, hot_side):
    ids = materialise(spark.range(0, 60_000, 1, 8), "ids")
    hot_rows = ids.select(hot("k", F.col("id")), F.sha2(F.col("id").cast("string"), 512).alias("payload"))
    flat_rows = ids.select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 512).alias("payload"))
    if hot_side == "left":
        kept = rows_in(hot_rows, flat_rows, {"k": "k"})
        assert "SortMergeJoin(skew=true)" in plan_of(kept)
        assert kept.count() == 60_000
    else:
        kept = rows_in(flat_rows, hot_rows, {"k": "k"})
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert plan.count("HashAggregate") == 2, "the right side is reduced on the map side"
        assert kept.count() == 40_001
