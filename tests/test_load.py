from __future__ import annotations

import os
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import FeedSpec
from tidemark.operators.projection import stamp_load_id
from tidemark.plans.load import incremental_load, incremental_rows, load_counts
from tidemark.plans.promote import promotion_manifest
from tidemark.plans.run import feed_reader, run_feeds, run_summary, shared_views
from tidemark.sinks import PathTarget, TableTarget
from tidemark.workspace import new_path, shared_folder

COLUMNS = "ID long, v string, HASH_VALUE string"


def batch_of(spark, pairs):
    return spark.createDataFrame([(i, v, f"{i}|{v}") for i, v in pairs], COLUMNS)


@pytest.fixture
def target(spark):
    schema = stamp_load_id(batch_of(spark, [(0, "")]), 0).schema
    return PathTarget(new_path(spark, "target"), schema, ("B_LOADID",))


def contents(spark, target):
    return sorted((r["B_LOADID"], r["ID"], r["v"]) for r in target.read(spark).collect())


def test_first_load_then_nothing_then_changes(spark, target):
    first = batch_of(spark, [(i, "a") for i in range(10)])
    assert incremental_load(first, target, keys="ID", load_id=1).inserted == 10
    again = incremental_load(first, target, keys="ID", load_id=2)
    assert (again.retrieved, again.inserted, again.columns) == (10, 0, 4)
    # Four changed hashes give exactly four rows.
    changed = batch_of(spark, [(i, "b" if i < 4 else "a") for i in range(10)])
    assert incremental_load(changed, target, keys="ID", load_id=3).inserted == 4
    assert len(contents(spark, target)) == 14


def test_reversion_is_loaded_and_deletion_is_not_noticed(spark, target):
    for load_id, pairs, inserted in [
        (1, [(1, "a"), (2, "x")], 2), (2, [(1, "b"), (2, "x")], 1), (3, [(1, "a"), (2, "x")], 1), (4, [(1, "a")], 0)
    ]:
        assert incremental_load(batch_of(spark, pairs), target, keys="ID", load_id=load_id).inserted == inserted
    assert contents(spark, target) == [(1, 1, "a"), (1, 2, "x"), (2, 1, "b"), (3, 1, "a")]


def test_used_load_id_is_refused_or_replaced(spark, target):
    batch = batch_of(spark, [(1, "a"), (2, "b")])
    incremental_load(batch, target, keys="ID", load_id=1)
    with pytest.raises(ValueError, match="already has rows"):
        incremental_load(batch, target, keys="ID", load_id=1)
    result = incremental_load(batch_of(spark, [(1, "c")]), target, keys="ID", load_id=1, delete_first=True, land=False)
    assert (result.retrieved, result.inserted) == (1, 1)
    assert contents(spark, target) == [(1, 1, "c")]


def test_catalogue_table_as_target(spark):
    schema = stamp_load_id(batch_of(spark, [(0, "")]), 0).schema
    table = TableTarget("load_target", schema, ("B_LOADID",))
    table.create(spark)
    assert incremental_load(batch_of(spark, [(1, "a"), (2, "b")]), table, keys="ID", load_id=1).inserted == 2
    assert incremental_load(batch_of(spark, [(1, "a"), (2, "c")]), table, keys="ID", load_id=2).inserted == 1
    assert contents(spark, table) == [(1, 1, "a"), (1, 2, "b"), (2, 2, "c")]
    spark.sql("DROP TABLE load_target")


def test_rows_null_hash_nan_and_repeats(spark):
    batch = spark.createDataFrame(
        [(1, float("nan"), "h1"), (2, 2.0, None), (3, 3.0, "h3"), (3, 3.0, "h3"), (4, 4.0, "h4")],
        "ID long, x double, HASH_VALUE string",
    )
    target = spark.createDataFrame(
        [(1, 1, "old"), (4, 1, "h4"), (4, 2, "newer"), (9, 1, None)], "ID long, B_LOADID long, HASH_VALUE string"
    )
    fresh = incremental_rows(batch, target, keys="ID", load_id=5)
    # h4 is only an older version's hash, so it is loaded; the NULL hash equals that of key 9.
    assert sorted((r["ID"], r["x"], r["B_LOADID"]) for r in fresh.where("ID > 1").collect()) == [
        (3, 3.0, 5), (3, 3.0, 5), (4, 4.0, 5)
    ]
    assert fresh.where("ID = 1").first()["x"] is None


def test_binary_and_numeric_hashes(spark):
    batch = spark.createDataFrame([(1, bytearray(b"\x01")), (2, bytearray(b"\x02"))], "ID long, HASH_VALUE binary")
    target = spark.createDataFrame([(1, 1, "01")], "ID long, B_LOADID long, HASH_VALUE string")
    assert [r["HASH_VALUE"] for r in incremental_rows(batch, target, keys="ID", load_id=2).collect()] == ["02"]
    numeric = spark.createDataFrame([(1, 11), (2, 12)], "ID long, HASH_VALUE long")
    text = spark.createDataFrame([(1, 1, "11")], "ID long, B_LOADID long, HASH_VALUE string")
    assert [r["HASH_VALUE"] for r in incremental_rows(numeric, text, keys="ID", load_id=2).collect()] == ["12"]
    other = spark.createDataFrame([(1, 1, "old-style hash")], "ID long, B_LOADID long, HASH_VALUE string")
    assert incremental_rows(numeric, other, keys="ID", load_id=2).count() == 2


def test_binary_hash_column_in_target_is_refused(spark):
    batch = spark.createDataFrame([(1, bytearray(b"\x01"))], "ID long, HASH_VALUE binary")
    target = PathTarget(new_path(spark, "binary"), stamp_load_id(batch, 0).schema)
    with pytest.raises(ValueError, match="as text or number"):
        incremental_load(batch, target, keys="ID", load_id=1)


def test_missing_columns_are_reported(spark):
    good = batch_of(spark, [(1, "a")])
    target = stamp_load_id(good, 1)
    with pytest.raises(ValueError, match="batch lacks"):
        incremental_rows(good.drop("HASH_VALUE"), target, keys="ID", load_id=2)
    with pytest.raises(ValueError, match="target lacks"):
        incremental_rows(good, target.drop("ID"), keys="ID", load_id=2)
    with pytest.raises(ValueError, match="match_on"):
        incremental_rows(good, target, keys="ID", load_id=2, match_on="key")


def test_names_match_in_any_case(spark, target):
    batch = batch_of(spark, [(1, "a")]).toDF("id", "V", "hash_value")
    assert incremental_load(batch, target, keys="ID", load_id=1).inserted == 1
    assert incremental_load(batch, target, keys="Id", load_id=2).inserted == 0
    assert contents(spark, target) == [(1, 1, "a")]


def test_landed_batch_is_removed_after_success_only(spark, target):
    def landings():
        folder = shared_folder(spark)
        return {name for name in os.listdir(folder) if name.startswith("landed-77")}

    incremental_load(batch_of(spark, [(1, "a")]), target, keys="ID", load_id=77)
    assert not landings()
    with pytest.raises(ValueError, match="no columns"):
        incremental_load(batch_of(spark, [(2, "a")]).withColumn("extra", F.lit(1)), target, keys="ID", load_id=778)
    assert len(landings()) == 1


def test_counts_add_up(spark):
    batch = batch_of(spark, [(i, "a") for i in range(6)]).withColumn("feed", F.col("ID") % 2)
    latest = batch_of(spark, [(0, "a"), (1, "b"), (2, "a")])
    counts = {r["feed"]: (r["retrieved"], r["inserted"]) for r in load_counts(batch, latest, ["feed"]).collect()}
    assert counts == {0: (3, 1), 1: (3, 3)}


def test_run_isolates_failures_and_serialises_one_target(spark):
    schema = stamp_load_id(batch_of(spark, [(0, "")]), 0).schema
    shared = PathTarget(new_path(spark, "shared"), schema, ("B_LOADID",))
    other = PathTarget(new_path(spark, "other"), schema, ("B_LOADID",))
    specs = [
        FeedSpec("SA_SHARED", "one", 12, "ID", source_database="d1"),
        FeedSpec("SA_SHARED", "two", 109, "ID", source_database="d2"),
        FeedSpec("SA_OTHER", "one", 3, "ID", source_database="d1"),
        FeedSpec("SA_BROKEN", "one", 4, "ID", source_database="d1"),
    ]

    def read(spec):
        if spec.target_table == "SA_BROKEN":
            raise RuntimeError("source is down")
        return batch_of(spark, [(1, "a"), (2, "b")] + ([(3, "c")] if spec.company == "two" else []))

    audit = run_feeds(
        spark, specs, read=read, load_id=lambda spec: 1000 + spec.hierarchy,
        target=lambda spec: shared if spec.target_table == "SA_SHARED" else other,
    ).cache()
    outcome = {(r["target_table"], r["company"]): (r["status"], r["retrieved"], r["inserted"]) for r in audit.collect()}
    assert outcome == {
        ("SA_SHARED", "one"): ("loaded", 2, 2),
        ("SA_SHARED", "two"): ("loaded", 3, 1),
        ("SA_OTHER", "one"): ("loaded", 2, 2),
        ("SA_BROKEN", "one"): ("failed", None, None),
    }
    assert "source is down" in audit.where("status = 'failed'").first()["error"]
    assert run_summary(audit).first().asDict() == {"feeds": 4, "failed": 1, "retrieved": 7, "inserted": 5}
    manifest = promotion_manifest(audit, function="f", job="j", user="u")
    assert [r["load_id"] for r in manifest.orderBy("seq").collect()] == [1003, 1012, 1109]


def test_summary_of_no_feeds(spark):
    audit = run_feeds(spark, [], read=None, target=None, load_id=None)
    assert run_summary(audit).first().asDict() == {"feeds": 0, "failed": 0, "retrieved": 0, "inserted": 0}
    assert isinstance(audit.schema["load_id"].dataType, T.LongType)


def test_feeds_of_both_kinds_are_read(spark):
    views = {"units": batch_of(spark, [(1, "a")]), "blocks": batch_of(spark, [(2, "b")])}
    read = feed_reader(
        lambda spec, view: views[view],
        {"both": lambda view: view("units").unionByName(view("blocks"))},
    )
    spec = FeedSpec("SA_X", "one", 1, "ID", statement="units")
    assert read(spec).count() == 1
    assert read(replace(spec, statement="both")).count() == 2
    with pytest.raises(KeyError):
        read(replace(spec, statement="absent"))


def test_shared_views_are_read_once_and_removed(spark):
    reads = []

    def read_view(spec, view):
        reads.append(view)
        return batch_of(spark, [(1, "a")])

    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    with shared_views(spark, read_view, ["survey"]) as read:
        spec = FeedSpec("SA_X", "one", 1, "ID")
        for view in ("survey", "survey", "other", "other", "survey"):
            assert read(spec, view).count() == 1
        assert read(replace(spec, company="two"), "survey").count() == 1
    assert reads == ["survey", "other", "other", "survey"]
    assert set(folder.iterdir()) == before
