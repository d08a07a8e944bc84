from __future__ import annotations

from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark import FeedSpec, feed_counts, feeds_frame, load_specs, select_feeds
from tidemark.operators.membership import rows_in, rows_not_in
from tidemark.operators.numbering import global_row_number
from tidemark.sinks.schema import create_like
from tidemark.workspace import intermediates, shared_folder
from tidemark.operators.profile import count_rows, describe_columns, null_profile, view_profile
from tidemark.operators.projection import (
    active_at,
    constant_columns,
    not_in,
    positional_columns,
    project_rename,
    stamp_load_id,
    union_all_padded,
)
from tidemark.operators.versions import hash_anti_join, latest_per_key, mark_new, next_load_id, without_load
from tidemark.plans.promote import promotion_manifest

HISTORY = "k string, B_LOADID long, HASH_VALUE string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


class TestLatestPerKey:
    def test_ties_kept_nulls_dropped(self, spark):
        df = spark.createDataFrame([
            ("a", 1, "a1"), ("a", 2, "a2"), ("a", 3, "a3"),
            ("b", 2, "b2"), ("b", 2, "b2x"), ("b", 1, "b1"),
            (None, 9, "n9"), ("c", None, "c"), ("d", None, "d"), ("d", 1, "d1"),
            ("e", 1, None),
        ], HISTORY)
        assert rows(latest_per_key(df, "k").select("k", "HASH_VALUE")) == sorted(
            [("a", "a3"), ("b", "b2"), ("b", "b2x"), ("d", "d1"), ("e", None)], key=str
        )

    def test_composite_key(self, spark):
        df = spark.createDataFrame([(1, 1, 1), (1, 1, 2), (1, 2, 1), (None, 2, 5)], "s int, k int, v long")
        assert rows(latest_per_key(df, ["s", "k"], "v").select("s", "k", "v")) == [(1, 1, 2), (1, 2, 1)]

    def test_empty(self, spark):
        assert latest_per_key(spark.createDataFrame([], HISTORY), "k").isEmpty()

    @settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
    @given(st.lists(st.tuples(
        st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 5)
    ), min_size=1, max_size=25))
    def test_against_brute_force(self, spark, data):
        df = spark.createDataFrame(data, "k int, B_LOADID long, h int")
        known = [r for r in data if r[0] is not None and r[1] is not None]
        expected = [r for r in known if r[1] == max(o[1] for o in known if o[0] == r[0])]
        assert rows(latest_per_key(df, "k").select("k", "B_LOADID", "h")) == sorted(expected, key=str)


class TestHashAntiJoin:
    BATCH = [("a", "1"), ("b", "2"), ("c", None), ("d", "1"), ("e", "9"), ("e", "9")]

    def frame(self, spark, data):
        return spark.createDataFrame(data, "k string, HASH_VALUE string")

    def test_hash_of_another_key_hides_and_repeats_stay(self, spark):
        batch, latest = self.frame(spark, self.BATCH), self.frame(spark, [("z", "1"), ("z", "1")])
        assert rows(hash_anti_join(batch, latest)) == sorted([("b", "2"), ("c", None), ("e", "9"), ("e", "9")], key=str)

    def test_null_matches_null(self, spark):
        batch, latest = self.frame(spark, self.BATCH), self.frame(spark, [("z", None)])
        kept = rows(hash_anti_join(batch, latest))
        assert ("c", None) not in kept and len(kept) == 5

    def test_key_and_hash(self, spark):
        batch, latest = self.frame(spark, self.BATCH), self.frame(spark, [("a", "1"), ("c", None)])
        kept = rows(hash_anti_join(batch, latest, keys="k"))
        assert kept == sorted([("b", "2"), ("d", "1"), ("e", "9"), ("e", "9")], key=str)

    def test_empty_sides(self, spark):
        batch, none = self.frame(spark, self.BATCH), self.frame(spark, [])
        assert hash_anti_join(batch, none).count() == 6
        assert hash_anti_join(none, batch).isEmpty()

    def test_mark_new_agrees(self, spark):
        batch, latest = self.frame(spark, self.BATCH), self.frame(spark, [("z", "1"), ("z", None), ("y", None)])
        marked = mark_new(batch, latest)
        assert marked.count() == 6
        assert rows(marked.where("is_new").drop("is_new")) == rows(hash_anti_join(batch, latest))


    @settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
    @given(
        st.lists(st.one_of(st.none(), st.sampled_from("abcd")), max_size=12),
        st.lists(st.one_of(st.none(), st.sampled_from("abcd")), max_size=6),
    )
    def test_against_brute_force(self, spark, hashes, seen):
        batch = self.frame(spark, [(str(i), h) for i, h in enumerate(hashes)])
        latest = self.frame(spark, [("z", h) for h in seen])
        expected = [(str(i), h) for i, h in enumerate(hashes) if h not in seen]
        assert rows(hash_anti_join(batch, latest)) == sorted(expected, key=str)


class TestMembership:
    def test_null_equals_nothing_in_a_semi_join(self, spark):
        left = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (3, "d")], "k int, t string")
        right = spark.createDataFrame([(1,), (1,), (None,)], "j int")
        assert rows(rows_in(left, right, {"k": "j"}).select("t")) == [("a",), ("b",)]
        assert rows(rows_not_in(left, right, {"k": "j"}).select("t")) == [("d",)]

    def test_two_columns(self, spark):
        left = spark.createDataFrame([(1, "a"), (1, None), (2, "a")], "k int, t string")
        assert rows(rows_in(left, left.where("k = 1"), {"k": "k", "t": "t"})) == [(1, "a")]
        assert rows(rows_not_in(left, left.where("k = 1"), {"k": "k", "t": "t"})) == [(2, "a")]


class TestLoadIds:
    def test_next(self, spark):
        target = spark.createDataFrame([(3,), (None,), (7,)], "B_LOADID long")
        other = spark.createDataFrame([(40,)], "id int")
        empty, nothing = target.where("false"), other.where("false")
        assert next_load_id(target, other, fallback_col="id").first()[0] == 8
        assert next_load_id(empty, other, fallback_col="id").first()[0] == 41
        assert next_load_id(empty, nothing, fallback_col="id").first()[0] == 1

    def test_without_load_keeps_null(self, spark):
        df = spark.createDataFrame([(1,), (2,), (None,)], "B_LOADID long")
        assert rows(without_load(df, 2)) == sorted([(1,), (None,)], key=str)

    def test_stamp_is_first_and_refuses_a_second(self, spark):
        df = spark.createDataFrame([("x",)], "a string")
        stamped = stamp_load_id(df, 5)
        assert stamped.columns == ["B_LOADID", "a"] and stamped.dtypes[0][1] == "bigint"
        with pytest.raises(ValueError):
            stamp_load_id(stamped, 6)


class TestNumbering:
    DATA = [("b", 2, "x"), ("a", 1, "y"), (None, 9, "z"), ("b", 1, "w"), ("b", 1, "v"), (None, None, "u"), ("a", 1, "y")]

    def test_nulls_first_and_ties_by_rest(self, spark):
        df = spark.createDataFrame(self.DATA, "k string, n int, t string").repartition(4)
        numbered = global_row_number(df, ["k", "n"], "id")
        assert numbered.columns == ["id", "k", "n", "t"]
        assert [tuple(r) for r in numbered.orderBy("id").collect()] == [
            (1, None, None, "u"), (2, None, 9, "z"), (3, "a", 1, "y"), (4, "a", 1, "y"),
            (5, "b", 1, "v"), (6, "b", 1, "w"), (7, "b", 2, "x"),
        ]

    def test_empty(self, spark):
        df = spark.createDataFrame([], "k string, n int")
        assert global_row_number(df, ["k"], "id").isEmpty()

    def test_columns_of_any_name_are_kept(self, spark):
        df = spark.createDataFrame([(i % 3, 9, 8, 7, 6, 5) for i in range(50)], "k int, _part int, _place int, _copy int, _offset int, `row` int")
        found = global_row_number(df, ["k"], "n")
        assert {tuple(r[2:]) for r in found.collect()} == {(9, 8, 7, 6, 5)}
        assert sorted(r["n"] for r in found.collect()) == list(range(1, 51))

    def test_nothing_is_left_behind(self, spark):
        folder = Path(shared_folder(spark).removeprefix("file:"))
        before = set(folder.iterdir())
        with intermediates(spark):
            assert global_row_number(spark.range(9).selectExpr("id % 2 AS k"), ["k"], "n").count() == 9
            assert len(set(folder.iterdir()) - before) == 1
        assert set(folder.iterdir()) == before

    def test_lost_lineage_is_not_needed(self, spark):
        numbered = global_row_number(spark.range(50), [-F.col("id")], "n")
        plan = numbered._jdf.queryExecution().optimizedPlan().toString()
        assert "Range" not in plan
        assert rows(numbered.where("n = 1").select("id")) == [(49,)]


class TestProjection:
    def test_rename_constants_positions(self, spark):
        df = spark.createDataFrame([(1, "x")], "`a b` int, c string")
        assert project_rename(df, {"A": "a b", "C": F.upper("c")}).first().asDict() == {"A": 1, "C": "X"}
        typed = constant_columns(df, N=41, T="41")
        assert dict(typed.dtypes)["N"] == "int" and dict(typed.dtypes)["T"] == "string"
        assert positional_columns(df).columns == ["0", "1"]

    def test_not_in_drops_null_and_ignores_blanks(self, spark):
        df = spark.createDataFrame([("HHSRS",), ("Portfolio",), ("Portfolio ",), (None,), ("ok",)], "e string")
        assert rows(df.where(not_in(F.col("e"), ["HHSRS", "Portfolio "]))) == [("ok",)]

    def test_active_at(self, spark):
        df = spark.createDataFrame([
            (1, "2020-01-01", None), (2, "2020-01-01", "2020-06-01"), (3, None, None), (4, "2020-06-01", "2020-07-01"),
            (5, "2020-01-01", "2020-05-31"),
        ], "i int, s string, e string")
        ts = lambda c: F.col(c).cast("timestamp_ntz")
        active = df.where(active_at(F.lit("2020-06-01").cast("timestamp_ntz"), ts("s"), ts("e")))
        assert rows(active.select("i")) == [(1,), (2,), (4,)]

    def test_union_pads_both_sides(self, spark):
        a = spark.createDataFrame([(1, "x")], "i int, a string")
        b = spark.createDataFrame([(2, 1.5)], "i int, b double")
        union = union_all_padded(a, b, a)
        assert union.dtypes == [("i", "int"), ("a", "string"), ("b", "double")]
        assert rows(union) == sorted([(1, "x", None), (2, None, 1.5), (1, "x", None)], key=str)


class TestProfile:
    def test_profiles(self, spark):
        df = spark.createDataFrame([(1, None), (2, "x")], "`a.b` int, c string")
        assert rows(count_rows(df)) == [(2,)]
        assert rows(view_profile({"v": df, "w": df.where("false")})) == [("v", 2, 2, "a.b, c"), ("w", 0, 2, "a.b, c")]
        assert rows(describe_columns(df).drop("nullable")) == [(0, "a.b", "int", None), (1, "c", "string", None)]
        assert rows(null_profile(df)) == [("a.b", 0), ("c", 1)]

    def test_declared_columns(self, spark):
        spark.sql("CREATE TABLE declared (a INT NOT NULL, b VARCHAR(2000), c INT DEFAULT 7) USING parquet")
        found = rows(describe_columns(spark.table("declared"), "declared"))
        assert [r[:3] for r in found] == [(0, "a", "int"), (1, "b", "string"), (2, "c", "int")] and found[2][4] == "7"
        made = create_like(spark, spark.table("declared").schema, "declared")
        declared = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE {made.name}").collect()}
        assert declared["b"] == "varchar(1000)"
        with pytest.raises(Exception, match="(?i)length|limitation"):
            made.append(spark.sql("SELECT 1, repeat('x', 1500), 2"))
        for name in ("declared", "_declared"):
            spark.sql(f"DROP TABLE {name}")


class TestSpecs:
    SPECS = [
        FeedSpec("SA_B", "x", 2, "ID", "s", "main", "SELECT * FROM b"),
        FeedSpec("SA_A", "x", 1, "SRC, ID", "s", "skipped", "SELECT * FROM a"),
        FeedSpec("SA_A", "y", 3, "ID", "s", None, "SELECT * FROM a2"),
    ]

    def test_round_trip_in_order(self, spark):
        back = load_specs(feeds_frame(spark, self.SPECS))
        assert back == sorted(self.SPECS, key=lambda s: s.hierarchy)
        assert back[0].keys == ["SRC", "ID"]

    def test_selection_and_counts(self, spark):
        feeds = feeds_frame(spark, self.SPECS)
        assert rows(select_feeds(feeds, ["x", "y"], ["skipped"]).select("hierarchy")) == [(2,), (3,)]
        assert rows(select_feeds(feeds, ["x"]).select("hierarchy")) == [(1,), (2,)]
        assert rows(feed_counts(feeds)) == [("TOTAL", 3), ("x", 2), ("y", 1)]


class TestPromotion:
    AUDIT = "hierarchy int, load_id long, target_table string, inserted long"
    NAMES = {"function": "f", "job": "j", "user": "u"}

    def test_order_and_empty_loads(self, spark):
        audit = spark.createDataFrame(
            [(19, 7, "C", 1), (1, 9, "A", 5), (19, 5, "B", 2), (2, 6, "Z", 0), (3, 8, "F", None)], self.AUDIT
        )
        manifest = promotion_manifest(audit, **self.NAMES)
        assert [(r["seq"], r["table"], r["load_id"]) for r in manifest.orderBy("seq").collect()] == [
            (1, "A", 9), (2, "B", 5), (3, "C", 7)
        ]

    def test_duplicate_load_id(self, spark):
        audit = spark.createDataFrame([(1, 7, "A", 1), (2, 7, "B", 1)], self.AUDIT)
        with pytest.raises(PySparkException, match="load id occurs twice"):
            promotion_manifest(audit, **self.NAMES).collect()
