from __future__ import annotations

import pytest
from pyspark.sql import types as T

from tidemark import FeedSpec
from tidemark.sinks import (
    JdbcTarget,
    PathTarget,
    TableTarget,
    append_by_name,
    append_by_position,
    create_like,
    delete_load,
    map_schema,
    map_type,
    mapped,
    truncate,
)
from tidemark.sources import (
    JdbcConnection,
    ParquetSource,
    SqlSource,
    TableSource,
    connection_for,
    hash_predicates,
    jdbc_options,
    list_tables,
    range_partitioning,
    read_source,
    source_for,
)
from tidemark.sources.jdbc import jdbc_write_options
from tidemark.workspace import new_path, shared_folder

SQLSERVER = JdbcConnection("sqlserver", "db.example", "housing", options={"user": "u", "password": "p"})
ORACLE = JdbcConnection("oracle", "ora.example", "SERVICE", port=1600)
SCHEMA = T.StructType([
    T.StructField("B_LOADID", T.LongType()), T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())
])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


class TestJdbc:
    def test_options_of_a_statement(self):
        options = jdbc_options(SQLSERVER, "SELECT * FROM v;\n")
        assert options["url"] == "jdbc:sqlserver://db.example:1433;databaseName=housing"
        assert options["dbtable"] == "(SELECT * FROM v) src"
        assert options["driver"].endswith("SQLServerDriver") and options["user"] == "u"

    def test_options_of_a_table_in_ranges(self):
        options = jdbc_options(ORACLE, "hou.units", partitioning=range_partitioning("id", 1, 900, 64))
        assert options["url"] == "jdbc:oracle:thin:@//ora.example:1600/SERVICE"
        assert options["dbtable"] == "hou.units"
        assert (options["partitionColumn"], options["lowerBound"], options["upperBound"], options["numPartitions"]) == (
            "id", "1", "900", "64"
        )

    @pytest.mark.parametrize("text, relation, prepare", [
        ("withdrawals", "withdrawals", None),
        ("-- the view\nSELECT 1 x", "(SELECT 1 x) src", None),
        ("/* a */ WITH a AS (SELECT ')' x) SELECT * FROM a;", "(SELECT * FROM a) src", "WITH a AS (SELECT ')' x)"),
    ])
    def test_statements_and_names(self, text, relation, prepare):
        options = jdbc_options(SQLSERVER, text)
        assert options["dbtable"] == relation and options.get("prepareQuery") == prepare
        assert options["preferTimestampNTZ"] == "true"
        assert "prepareQuery" not in jdbc_options(ORACLE, text)

    def test_a_feed_says_how_its_read_is_split(self):
        by_hash = source_for(FeedSpec("T", "c", 1, "ID", statement="v", split_column="ID"), {"c": SQLSERVER})
        assert (by_hash.hash_column, by_hash.hash_partitions, by_hash.partitioning) == ("ID", 32, None)
        ranges = FeedSpec("T", "c", 1, "ID", statement="v", split_column="ID", split_parts=8, split_lower="1", split_upper="99")
        assert source_for(ranges, {"c": SQLSERVER}).partitioning == range_partitioning("ID", 1, 99, 8)

    def test_hash_predicates_cover_all_parts(self):
        assert hash_predicates("oracle", "id", 3) == [f"ORA_HASH(id, 2) = {i}" for i in range(3)]
        assert len(set(hash_predicates("sqlserver", "id", 5))) == 5
        with pytest.raises(ValueError):
            hash_predicates("other", "id", 2)

    def test_unknown_database_kind(self):
        with pytest.raises(ValueError):
            JdbcConnection("other", "h", "d")

    def test_credentials_are_not_shown(self):
        assert "password" not in repr(SQLSERVER)

    def test_write_options(self):
        assert jdbc_write_options(ORACLE, "SA_X", batch_size=5)["batchsize"] == "5"

    def test_source_by_company(self):
        connections = {"one": SQLSERVER, "two": ORACLE}
        source = source_for(FeedSpec("SA_X", "one", 1, "ID", "other.example", "live", "SELECT * FROM x"), connections)
        assert (source.connection.host, source.connection.database) == ("other.example", "live")
        assert source.connection.options == SQLSERVER.options
        assert connection_for("two", connections) is ORACLE
        with pytest.raises(ValueError, match="no source database"):
            connection_for("three", connections)
        with pytest.raises(ValueError, match="no statement"):
            source_for(FeedSpec("SA_X", "one", 1, "ID"), connections)


class TestReaders:
    def test_kinds(self, spark, tmp_path):
        path = str(tmp_path / "p")
        spark.range(3).write.parquet(path)
        spark.range(2).createOrReplaceTempView("small_view")
        assert read_source(spark, ParquetSource(path)).count() == 3
        assert read_source(spark, TableSource("small_view")).count() == 2
        assert rows(read_source(spark, SqlSource("SELECT max(id) AS m FROM small_view"))) == [(1,)]
        with pytest.raises(ValueError):
            read_source(spark, "small_view")

    def test_list_tables(self, spark):
        spark.range(2).createOrReplaceTempView("listed_view")
        spark.sql("CREATE TABLE listed_table (a INT) USING parquet")
        found = {(r["table_name"], r["is_view"]) for r in list_tables(spark).collect()}
        assert {("listed_view", True), ("listed_table", False)} <= found
        spark.sql("DROP TABLE listed_table")


@pytest.fixture(params=["path", "path by load", "table", "table by load"])
def target(request, spark):
    partition_by = ("B_LOADID",) if "by load" in request.param else ()
    if request.param.startswith("path"):
        yield PathTarget(new_path(spark, "sink"), SCHEMA, partition_by)
    else:
        table = TableTarget("sink_table", SCHEMA, partition_by)
        table.create(spark)
        yield table
        spark.sql("DROP TABLE sink_table")


class TestSinks:
    def test_append_by_name_reorders_and_fills(self, spark, target):
        append_by_name(spark.createDataFrame([("x", 1, 5)], "b string, B_LOADID long, a int"), target)
        append_by_name(spark.createDataFrame([("y", 2)], "b string, B_LOADID int"), target)
        assert rows(target.read(spark).select("B_LOADID", "a", "b")) == [(1, 5, "x"), (2, None, "y")]
        with pytest.raises(ValueError, match="no columns"):
            append_by_name(spark.createDataFrame([(1,)], "z int"), target)

    def test_append_by_position(self, spark, target):
        columns = target.columns(spark).names
        values = {"B_LOADID": 1, "a": 2, "b": "x"}
        batch = spark.createDataFrame([tuple(values[c] for c in columns)]).toDF("0", "1", "2")
        append_by_position(batch, target)
        assert rows(target.read(spark).select("B_LOADID", "a", "b")) == [(1, 2, "x")]
        with pytest.raises(ValueError, match="2 columns"):
            append_by_position(batch.drop("2"), target)

    def test_delete_load_and_truncate(self, spark, target):
        append_by_name(spark.createDataFrame([(1, 1, "x"), (2, 2, "y"), (2, 3, "z"), (None, 4, "n")], SCHEMA), target)
        delete_load(spark, target, 2)
        delete_load(spark, target, 77)
        assert rows(target.read(spark).select("B_LOADID", "a")) == sorted([(1, 1), (None, 4)], key=str)
        truncate(spark, target)
        assert target.read(spark).count() == 0
        assert sorted(target.read(spark).columns) == sorted(SCHEMA.names)
        append_by_name(spark.createDataFrame([(5, 5, "q")], SCHEMA), target)
        assert target.read(spark).count() == 1

    @pytest.mark.parametrize("kind", ["path", "table"])
    def test_delete_load_when_partitioned_by_something_else(self, spark, kind):
        if kind == "path":
            target = PathTarget(new_path(spark, "by-b"), SCHEMA, ("b",))
        else:
            target = TableTarget("sink_by_b", SCHEMA, ("b",))
            target.create(spark)
        append_by_name(spark.createDataFrame([(1, 1, "x"), (2, 2, "y"), (2, 3, "x")], SCHEMA), target)
        delete_load(spark, target, 2)
        # Partition y has no rows left and must be gone.
        assert rows(target.read(spark).select("B_LOADID", "a", "b")) == [(1, 1, "x")]
        if kind == "table":
            spark.sql("DROP TABLE sink_by_b")

    def test_missing_path_is_empty(self, spark):
        target = PathTarget(new_path(spark, "absent"), SCHEMA)
        assert not target.exists(spark) and target.read(spark).isEmpty()
        delete_load(spark, target, 1)

    def test_database_rows_are_not_deleted_from_here(self, spark):
        with pytest.raises(ValueError, match="cannot delete"):
            delete_load(spark, JdbcTarget(ORACLE, "SA_X"), 1)


class TestSchemas:
    def test_types(self):
        assert map_type(T.LongType()) == T.DecimalType(19, 0)
        assert map_type(T.VarcharType(4000)) == T.VarcharType(1000)
        assert map_type(T.VarcharType(1000)) == T.VarcharType(1000)
        assert map_type(T.StringType()) == T.StringType()

    def test_schema_keeps_names_and_nullability(self):
        schema = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.DoubleType())])
        assert map_schema(schema) == T.StructType([
            T.StructField("a", T.DecimalType(19, 0), False), T.StructField("b", T.DoubleType())
        ])

    def test_create_like(self, spark):
        source = spark.createDataFrame([(2**62, "x")], "id long, t string")
        target = create_like(spark, source.schema, "copied")
        assert target.name == "_copied"
        append_by_name(source, target)
        assert rows(spark.table("_copied")) == rows(mapped(source))
        assert dict(spark.table("_copied").dtypes)["id"] == "decimal(19,0)"
        spark.sql("DROP TABLE _copied")


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_shared_folder_without_the_setting_is_below_the_warehouse():
    class Unset:
        conf = {"spark.sql.warehouse.dir": "file:/data/warehouse/"}

    assert shared_folder(Unset) == "file:/data/warehouse/_tidemark"
