"""Targets with lists of committed loads, current versions, screening by bit sets, and the run's journal."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark import FeedSpec
from tidemark.operators.membership import rows_not_in
from tidemark.operators.projection import stamp_load_id
from tidemark.operators.screening import bit_sets, mark_perhaps_known, screened_rows_not_in, table_bits
from tidemark.operators.versions import latest_per_key
from tidemark.plans import load as load_plan
from tidemark.plans.current import CurrentVersions
from tidemark.plans.journal import RunJournal
from tidemark.plans.load import incremental_load, incremental_rows
from tidemark.plans.promote import promotion_manifest
from tidemark.plans.run import run_feeds
from tidemark.sinks import CommittedTarget, append_by_name, append_by_position, delete_load, truncate
from tidemark.workspace import names_in, new_path

COLUMNS = "ID long, v string, HASH_VALUE string"


def batch_of(spark, pairs):
    return spark.createDataFrame([(i, v, f"{i}|{v}") for i, v in pairs], COLUMNS)


@pytest.fixture
def target(spark):
    return CommittedTarget(new_path(spark, "committed"), stamp_load_id(batch_of(spark, [(0, "")]), 0).schema)


@pytest.fixture
def current(target):
    return CurrentVersions.of(target, "ID")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def load(spark, target, pairs, load_id, current=None, **options):
    return incremental_load(batch_of(spark, pairs), target, keys="ID", load_id=load_id, current=current, **options)


def files(spark, target):
    return sorted(n for c in target.committed(spark) for n in (c.files or target._data_files(spark, c.folder)))


class TestLists:
    def test_a_write_that_fails_half_way_is_not_seen(self, spark, target):
        load(spark, target, [(1, "a")], 1)
        before = rows(target.read(spark))
        # Some tasks write their part, one fails: nothing is named by a list, and readers see the old rows.
        bad = spark.range(0, 40, 1, 8).select(
            F.lit(2).cast("long").alias("B_LOADID"), F.col("id").alias("ID"), F.lit("x").alias("v"),
            F.when(F.col("id") == 39, F.raise_error(F.lit("lost"))).otherwise("h").alias("HASH_VALUE"))
        with pytest.raises(Exception, match="lost"):
            append_by_name(bad, target.for_load(2))
        assert rows(target.read(spark)) == before and target.version(spark) == 1
        # So is a whole write whose list was never put.
        stamped = stamp_load_id(batch_of(spark, [(9, "z")]), 2)
        target._write(stamped)
        assert rows(target.read(spark)) == before
        append_by_name(stamped, target.for_load(2))
        assert len(rows(target.read(spark))) == 2
        target.clean(spark)
        assert len([n for n in names_in(spark, target.path) if n.startswith("data-")]) == 2

    def test_a_load_replaces_its_own_attempt(self, spark, target):
        append_by_name(stamp_load_id(batch_of(spark, [(1, "a")]), 1), target.for_load(1))
        append_by_name(stamp_load_id(batch_of(spark, [(1, "b"), (2, "c")]), 1), target.for_load(1))
        assert [r[:3] for r in rows(target.read(spark))] == [(1, 1, "b"), (1, 2, "c")]

    def test_readers_that_have_begun_keep_their_files(self, spark, target):
        load(spark, target, [(1, "a"), (2, "b")], 1)
        old = target.read(spark)
        delete_load(spark, target, 1)
        assert old.count() == 2 and target.read(spark).count() == 0

    def test_deleting_a_load_rewrites_only_files_that_hold_it(self, spark, target):
        parts = [batch_of(spark, [(i, "a") for i in range(n, n + 10)]).coalesce(1) for n in (0, 10, 20)]
        append_by_name(stamp_load_id(parts[0], 1), target)
        append_by_name(stamp_load_id(parts[1], F.when(F.col("ID") % 2 == 0, 1).when(F.col("ID") % 3 == 0, F.lit(None)).otherwise(2)), target)
        append_by_name(stamp_load_id(parts[2], 3), target)
        before, held = files(spark, target), rows(target.read(spark).where("B_LOADID IS DISTINCT FROM 2").fillna(-1))
        delete_load(spark, target, 2)
        assert rows(target.read(spark).fillna(-1)) == held
        after = files(spark, target)
        assert len(set(before) & set(after)) == 2 and len(after) == 3
        version = target.version(spark)
        delete_load(spark, target, 77)
        assert target.version(spark) == version and files(spark, target) == after
        target.clean(spark)
        assert rows(target.read(spark).fillna(-1)) == held

    def test_part_of_a_folder_stays(self, spark, target):
        both = stamp_load_id(batch_of(spark, [(i, "a") for i in range(20)]), F.when(F.col("ID") < 10, 1).otherwise(2))
        append_by_name(both.repartitionByRange(2, "ID"), target)
        before = files(spark, target)
        delete_load(spark, target, 1)
        assert [r[1] for r in rows(target.read(spark))] == list(range(10, 20))
        assert set(files(spark, target)) & set(before) and target.committed(spark)[0].files is not None
        target.clean(spark)
        assert target.read(spark).count() == 10

    def test_other_writes(self, spark, target):
        append_by_position(stamp_load_id(batch_of(spark, [(1, "a")]), 1).toDF("a", "b", "c", "d"), target)
        assert target.read(spark).count() == 1 and target.exists(spark)
        truncate(spark, target)
        assert target.read(spark).count() == 0 and target.read(spark).columns == target.schema.names
        assert CommittedTarget(target.path + "x", target.schema).read(spark).count() == 0


class TestCurrentVersions:
    def test_same_as_the_history_after_every_load(self, spark, target, current):
        for load_id, pairs in [(1, [(1, "a"), (2, "x"), (None, "n")]), (2, [(1, "b"), (2, "x"), (3, "y"), (3, "z")]), (3, [(1, "a"), (3, "y")])]:
            load(spark, target, pairs, load_id, current, screened=load_id == 2)
            want = latest_per_key(target.read(spark), "ID").select("ID", "B_LOADID", "HASH_VALUE")
            assert rows(current.read(spark)) == rows(want)
        assert rows(current.read(spark)) == [(1, 3, "1|a"), (2, 1, "2|x"), (3, 2, "3|y"), (3, 2, "3|z")]

    def test_loads_agree_with_those_over_the_history(self, spark, target, current):
        other = CommittedTarget(target.path + "-plain", target.schema)
        for load_id, pairs in [(1, [(1, "a"), (2, "x")]), (2, [(1, "b"), (2, "x")]), (3, [(1, "a"), (2, "x")])]:
            assert load(spark, target, pairs, load_id, current) == load(spark, other, pairs, load_id)

    def test_a_load_does_not_scan_the_history(self, spark, target, current):
        load(spark, target, [(1, "a")], 1, current)
        plan = incremental_rows(batch_of(spark, [(1, "b")]), current.read(spark), keys="ID", load_id=2, current=True)
        assert all("/_current/data-" in f for f in plan.inputFiles()) and plan.inputFiles()
        assert "max(" not in plan._jdf.queryExecution().toString()  # no latest rows to find

    def test_a_crash_between_append_and_merge_is_repaired(self, spark, target, current, monkeypatch):
        load(spark, target, [(1, "a"), (2, "x")], 1, current)
        monkeypatch.setattr(CurrentVersions, "refresh", lambda self, spark: None)
        load(spark, target, [(1, "b"), (2, "x")], 2, current)
        monkeypatch.undo()
        assert [c.load for c in current.missing(spark)] == [2]
        assert load(spark, target, [(1, "b"), (2, "x")], 3, current).inserted == 0
        assert current.missing(spark) == []

    def test_a_deleted_load_makes_it_anew(self, spark, target, current):
        load(spark, target, [(1, "a")], 1, current)
        load(spark, target, [(1, "b")], 2, current)
        delete_load(spark, target, 2)
        assert current.missing(spark) is None
        assert rows(current.read(spark)) == [(1, 1, "1|a")]

    def test_wrong_columns_are_refused(self, spark, target, current):
        with pytest.raises(ValueError, match="other columns"):
            incremental_load(batch_of(spark, [(1, "a")]), target, keys="v", load_id=1, current=current)


class TestScreening:
    @pytest.mark.parametrize("bits_per_value", [1, 16])
    def test_same_rows_as_the_join(self, spark, bits_per_value):
        side = lambda n, m: spark.range(n).selectExpr(
            "id AS row", f"IF(id % {m} = 0, NULL, md5(CAST(id * {m} AS string))) AS h", "id % 3 AS set", "'x' AS number")
        df, other = side(3000, 5), side(2000, 7).union(side(500, 5))
        for columns in (["h"], ["h", "set"]):
            got = screened_rows_not_in(df, other, columns, bits_per_value=bits_per_value)
            want = rows_not_in(df, other, {c: c for c in columns})
            assert got.columns == df.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert screened_rows_not_in(df, other.limit(0), ["h"]).count() == 3000
        assert screened_rows_not_in(df, other, ["h"], most_bytes=1).count() == rows_not_in(df, other, {"h": "h"}).count()

    def test_few_new_rows_are_shuffled(self, spark):
        known = spark.range(20_000).selectExpr("md5(CAST(id AS string)) AS h")
        new = spark.range(20_000, 60_000).selectExpr("md5(CAST(id AS string)) AS h")
        bits = table_bits(20_000)
        sets = bit_sets(known, ["h"], bits)
        assert sets.count() <= bits // 32768
        marked = mark_perhaps_known(new.union(known), sets, ["h"], bits)
        assert marked.where("known").count() <= 20_000 + 40_000 / 12
        # Rows that miss the bits reach the result without an exchange: the only one over the batch is that of the join.
        plan = marked.where("NOT known")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastExchange" in plan  # the one that merges the bits


class TestJournal:
    SPECS = [FeedSpec("SA_A", "one", 1, "ID"), FeedSpec("SA_A", "two", 2, "ID"), FeedSpec("SA_B", "one", 3, "ID"), FeedSpec("SA_C", "one", 4, "ID")]

    def run(self, spark, folder, journal, ids, fail=()):
        batches = {s.hierarchy: [(i, s.company) for i in range(s.hierarchy)] for s in self.SPECS}
        schema = stamp_load_id(batch_of(spark, [(0, "")]), 0).schema
        read = []

        def batch(spec):
            read.append(spec.hierarchy)
            if spec.hierarchy in fail:
                raise KeyboardInterrupt  # not an error of the feed: the driver goes
            return batch_of(spark, batches[spec.hierarchy])

        number = iter(ids)
        try:
            audit = run_feeds(
                spark, self.SPECS, read=batch, target=lambda s: CommittedTarget(f"{folder}/{s.target_table}", schema),
                load_id=lambda s: next(number), journal=journal, max_concurrent=1)
        except KeyboardInterrupt:
            return None, read
        return audit, read

    def test_a_run_that_was_stopped_goes_on(self, spark):
        folder = new_path(spark, "run")
        journal = RunJournal(f"{folder}/journal")
        assert self.run(spark, folder, journal, range(10, 20), fail={3, 4}) == (None, [1, 2, 3, 4])
        assert [r["status"] for r in journal.audit(spark).orderBy("hierarchy").collect()] == ["loaded", "loaded", "started", "started"]
        audit, read = self.run(spark, folder, journal, range(14, 20))
        whole, _ = self.run(spark, new_path(spark, "run"), None, range(10, 20))
        assert read == [3, 4] and rows(audit.fillna("")) == rows(whole.fillna(""))
        assert rows(journal.audit(spark).fillna("")) == rows(audit.fillna(""))
        again, read = self.run(spark, folder, journal, range(30, 40))
        assert read == [] and rows(again.fillna("")) == rows(audit.fillna(""))
        manifest = promotion_manifest(again, function="SUBMIT_LOAD", job="INTEGRATE", user="loader")
        assert [r["load_id"] for r in manifest.orderBy("seq").collect()] == [10, 11, 12, 13]

    def test_what_an_attempt_left_is_replaced(self, spark, monkeypatch):
        folder = new_path(spark, "run")
        journal = RunJournal(f"{folder}/journal")

        def stop(*args, **options):
            incremental(*args, **options)
            raise KeyboardInterrupt  # after the append, before the journal knows

        incremental = load_plan.incremental_load
        monkeypatch.setattr("tidemark.plans.run.incremental_load", stop)
        assert self.run(spark, folder, journal, range(10, 20))[0] is None
        monkeypatch.undo()
        audit, _ = self.run(spark, folder, journal, range(13, 20))
        found = [(r["load_id"], r["inserted"]) for r in audit.orderBy("hierarchy").collect()]
        assert found[:3] == [(10, 1), (13, 2), (11, 3)] and found[3][1] == 4  # the third target may not have begun
        assert journal.states(spark).where("hierarchy = 1").count() == 3
