"""Key registries, reject tables and targets laid out by their key."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from tidemark import FeedSpec
from tidemark.functions.dates import text_to_date
from tidemark.operators.projection import stamp_load_id
from tidemark.operators.registry import KeyRegistry
from tidemark.operators.versions import latest_per_key
from tidemark.plans.load import incremental_load
from tidemark.plans.rejects import REJECT_SCHEMA, REJECTS, reject_marks
from tidemark.plans.run import run_feeds
from tidemark.sinks import CommittedTarget, TableTarget, append_by_name
from tidemark.workspace import new_path


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


class TestRegistry:
    def keys(self, spark, pairs):
        return spark.createDataFrame(pairs, "a string, b long")

    def test_numbers_stay_and_new_keys_get_the_next(self, spark):
        first = self.keys(spark, [("b", 1), ("d", 1), ("d", 1), (None, 2)])
        registry = KeyRegistry.of(new_path(spark, "keys"), first)
        assert registry.register(first, ["a"]) == 3
        before = rows(registry.numbered(first.distinct(), "n"))
        assert before == rows(spark.createDataFrame([(1, None, 2), (2, "b", 1), (3, "d", 1)], "n long, a string, b long"))
        more = self.keys(spark, [("a", 1), ("b", 1), ("c", None), (None, 2), ("d", 1)])
        assert registry.register(more, ["a"]) == 2
        assert registry.register(more, ["a"]) == 0
        found = rows(registry.numbered(more, "n"))
        assert set(before) < set(found) and {(4, "a", 1), (5, "c", None)} < set(found)

    def test_unknown_keys_and_no_keys(self, spark):
        none = self.keys(spark, [])
        registry = KeyRegistry.of(new_path(spark, "keys"), none)
        assert registry.register(none) == 0
        assert rows(registry.numbered(self.keys(spark, [("x", 1)]), "n")) == [(None, "x", 1)]

    def test_repeated_keys_have_one_number_and_all_rows_stay(self, spark):
        df = spark.range(300).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("a"), F.lit(1).cast("long").alias("b"))
        registry = KeyRegistry.of(new_path(spark, "keys"), df)
        assert registry.register(df) == 201
        numbered = registry.numbered(df, "n")
        assert numbered.count() == 300 and numbered.select("n").distinct().count() == 201
        assert numbered.agg(F.min("n"), F.max("n")).first()[:] == (1, 201)

    def test_a_second_load_inserts_only_added_rows(self, spark):
        """A row number would shift every later key and load its rows again."""
        registry, target = None, None
        inserted = []
        for load_id, names in [(1, ["b", "d", "f"]), (2, ["a", "b", "c", "d", "f"])]:
            df = spark.createDataFrame([(n,) for n in names], "a string")
            registry = registry or KeyRegistry.of(new_path(spark, "keys"), df)
            registry.register(df, ["a"])
            batch = registry.numbered(df, "ID").withColumn("HASH_VALUE", F.concat_ws("|", "ID", "a"))
            target = target or CommittedTarget(new_path(spark, "target"), stamp_load_id(batch, 0).schema)
            inserted.append(incremental_load(batch, target, keys="ID", load_id=load_id).inserted)
        assert inserted == [3, 2]


class TestRejects:
    def batch(self, spark, pairs):
        df = spark.createDataFrame(pairs, "ID long, d string, HASH_VALUE string")
        read = text_to_date(F.col("d"))
        text = F.when(F.rtrim("d") != "", F.col("d"))
        return df.select("ID", read.alias("d"), "HASH_VALUE", reject_marks({"d": (text, read)}))

    @pytest.fixture
    def target(self, spark):
        schema = stamp_load_id(self.batch(spark, []).drop(REJECTS), 0).schema
        return CommittedTarget(new_path(spark, "target"), schema)

    @pytest.fixture
    def rejects(self, spark):
        return CommittedTarget(new_path(spark, "rejects"), REJECT_SCHEMA)

    PAIRS = [(1, "2001-03-15", "a"), (2, "soon", "b"), (3, None, "c"), (4, " ", "d"), (None, "never", "e")]

    def test_rows_are_split_off_and_counted(self, spark, target, rejects):
        result = incremental_load(
            self.batch(spark, self.PAIRS), target, keys="ID", load_id=3, rejects=rejects, reject_as="T")
        assert (result.retrieved, result.inserted, result.rejected) == (5, 3, 2)
        assert [r[0] for r in rows(target.read(spark).select("ID"))] == [1, 3, 4]
        assert REJECTS not in target.read(spark).columns
        want = [(3, "T", "", "d", "never", "not a date"), (3, "T", "2", "d", "soon", "not a date")]
        assert rows(rejects.read(spark)) == want

    def test_without_a_table_it_is_an_error(self, spark, target):
        with pytest.raises(ValueError, match="2 rows cannot be read"):
            incremental_load(self.batch(spark, self.PAIRS), target, keys="ID", load_id=3)
        assert target.read(spark).count() == 0
        assert incremental_load(self.batch(spark, self.PAIRS[:1]), target, keys="ID", load_id=3).inserted == 1

    def test_a_repeated_load_leaves_its_rejects_once(self, spark, target, rejects):
        for _ in range(2):
            incremental_load(
                self.batch(spark, self.PAIRS), target, keys="ID", load_id=3, rejects=rejects, reject_as="T",
                delete_first=True)
        assert rejects.read(spark).count() == 2 and target.read(spark).count() == 3

    def test_the_audit_counts_them(self, spark, target, rejects):
        specs = [FeedSpec("T", "first", 1, "ID")]
        audit = run_feeds(
            spark, specs, read=lambda spec: self.batch(spark, self.PAIRS), target=lambda spec: target,
            load_id=lambda spec: 3, rejects=rejects)
        assert rows(audit.select("retrieved", "inserted", "rejected", "status")) == [(5, 3, 2, "loaded")]


class TestBucketedTarget:
    def target(self, spark, df):
        target = TableTarget(f"bucketed_{uuid.uuid4().hex}", df.schema, bucket_by=("ID",), buckets=4)
        target.create(spark)
        append_by_name(df, target)
        return target

    def test_latest_rows_without_moving_the_table(self, spark):
        """A third of the rows have one key; rows without key or version and ties are as over any table."""
        df = spark.range(900).select(
            F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40).cast("long").alias("ID"),
            F.when(F.col("id") % 70 == 2, None).otherwise(F.col("id") % 5).cast("long").alias("B_LOADID"),
            F.col("id").cast("string").alias("HASH_VALUE"))
        target = self.target(spark, df)
        assert target.bucketed_by(spark) == ("ID",)
        near = latest_per_key(target.read(spark), "ID", co_located=True)
        assert rows(near) == rows(latest_per_key(df, "ID"))
        held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            plan = latest_per_key(target.read(spark), "ID", co_located=True)._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
        assert "Exchange" not in plan and "Bucketed: true" in plan

    def test_a_load_into_it(self, spark):
        batch = lambda pairs: spark.createDataFrame([(i, v, f"{i}|{v}") for i, v in pairs], "ID long, v string, HASH_VALUE string")
        target = self.target(spark, stamp_load_id(batch([(1, "a"), (2, "b")]), 1))
        result = incremental_load(batch([(1, "a"), (2, "c"), (3, "d")]), target, keys="ID", load_id=2)
        assert result.inserted == 2
        assert [r[:3] for r in rows(target.read(spark).select("ID", "v", "B_LOADID").where("B_LOADID = 2"))] == [(2, "c", 2), (3, "d", 2)]
