"""Staging tables and the ways to write to them.

A staging table is append-only and best partitioned by its load id: an append then makes one new
partition, and deleting a load drops one. One writer per target at a time is a precondition.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.versions import without_load
from tidemark.sinks.committed import CommittedTarget
from tidemark.sources.jdbc import JdbcConnection, hash_predicates, jdbc_options, jdbc_write_options
from tidemark.specs import LOAD_COLUMN
from tidemark.workspace import delete_folder, empty_frame, landed


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


# Where a frame's schema keeps the declared type of a text with a length; the field itself is plain text.
DECLARED_TEXT = "__CHAR_VARCHAR_TYPE_STRING"


def declared_type(field: T.StructField) -> str:
    """The type to declare for a field, with the length of a text where it has one."""
    return field.metadata.get(DECLARED_TEXT, field.dataType.simpleString())


def _in_table_order(schema: T.StructType, partition_by: tuple[str, ...]) -> T.StructType:
    fields = {f.name: f for f in schema.fields}
    names = [n for n in schema.names if n not in partition_by] + list(partition_by)
    return T.StructType([fields[n] for n in names])


@dataclass(frozen=True)
class TableTarget:
    """A parquet table of the session's catalogue. `schema` is needed only to create it.

    `bucket_by` and `buckets` lay the rows out by their key, so that a load finds the latest version of every key without
    moving the table's rows. A bucket is read by one task, so there should be many more than a key's share of the rows.
    """

    name: str
    schema: T.StructType | None = None
    partition_by: tuple[str, ...] = ()
    bucket_by: tuple[str, ...] = ()
    buckets: int = 0

    def create(self, spark: SparkSession) -> None:
        if self.schema is None:
            raise ValueError(f"no schema to create {self.name} from")
        columns = ", ".join(f"`{f.name}` {declared_type(f)}" for f in self.schema.fields)
        partitions = ", ".join(f"`{c}`" for c in self.partition_by)
        clause = f" PARTITIONED BY ({partitions})" if partitions else ""
        if self.bucket_by:
            names = ", ".join(f"`{c}`" for c in self.bucket_by)
            clause += f" CLUSTERED BY ({names}) INTO {int(self.buckets)} BUCKETS"
        spark.sql(f"CREATE TABLE {_quoted(self.name)} ({columns}) USING parquet{clause}")

    def exists(self, spark: SparkSession) -> bool:
        return spark.catalog.tableExists(self.name)

    def columns(self, spark: SparkSession) -> T.StructType:
        return spark.table(self.name).schema

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)

    def append(self, df: DataFrame) -> None:
        df.write.insertInto(self.name)

    def overwrite(self, df: DataFrame) -> None:
        """Replace all rows by those of `df`, which must not read this table.

        `INSERT OVERWRITE` would leave partitions without new rows as they are when the session's
        overwrite mode is dynamic, so the table is emptied first.
        """
        self.truncate(df.sparkSession)
        self.append(df)

    def truncate(self, spark: SparkSession) -> None:
        spark.sql(f"TRUNCATE TABLE {_quoted(self.name)}")

    def drop_load(self, spark: SparkSession, load_id: int, load_col: str) -> bool:
        if self.partitioned_by(spark) != (load_col,):
            return False
        spark.sql(f"ALTER TABLE {_quoted(self.name)} DROP IF EXISTS PARTITION (`{load_col}` = {int(load_id)})")
        return True

    def partitioned_by(self, spark: SparkSession) -> tuple[str, ...]:
        return tuple(c.name for c in spark.catalog.listColumns(self.name) if c.isPartition)

    def bucketed_by(self, spark: SparkSession) -> tuple[str, ...]:
        """The columns by whose hash the stored table is laid out."""
        return tuple(c.name for c in spark.catalog.listColumns(self.name) if c.isBucket)


@dataclass(frozen=True)
class PathTarget:
    """A folder of parquet files; it need not exist before the first append."""

    path: str
    schema: T.StructType
    partition_by: tuple[str, ...] = ()

    def _read_if_there(self, spark: SparkSession) -> DataFrame | None:
        try:
            return spark.read.schema(self.columns(spark)).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def exists(self, spark: SparkSession) -> bool:
        return self._read_if_there(spark) is not None

    def columns(self, spark: SparkSession) -> T.StructType:
        return _in_table_order(self.schema, self.partition_by)

    def read(self, spark: SparkSession) -> DataFrame:
        there = self._read_if_there(spark)
        return empty_frame(spark, self.columns(spark)) if there is None else there

    def append(self, df: DataFrame) -> None:
        df.write.mode("append").partitionBy(*self.partition_by).parquet(self.path)

    def overwrite(self, df: DataFrame) -> None:
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy(*self.partition_by).parquet(self.path)

    def drop_load(self, spark: SparkSession, load_id: int, load_col: str) -> bool:
        if self.partition_by != (load_col,):
            return False
        delete_folder(spark, f"{self.path}/{load_col}={int(load_id)}")
        return True


@dataclass(frozen=True)
class JdbcTarget:
    """A database table. Each task commits its own part, so after a failed load the load must be deleted there first."""

    connection: JdbcConnection
    table: str
    partitioning: Mapping[str, str] | None = None
    hash_column: str | None = None
    hash_partitions: int = 32

    def exists(self, spark: SparkSession) -> bool:
        return True

    def columns(self, spark: SparkSession) -> T.StructType:
        return self.read(spark).schema

    def read(self, spark: SparkSession) -> DataFrame:
        """The table, read in parallel by `partitioning` or the hash of `hash_column`; a load selects three columns of it."""
        options = jdbc_options(self.connection, self.table, partitioning=self.partitioning, statement=False)
        if self.hash_column is None:
            return spark.read.format("jdbc").options(**options).load()
        predicates = hash_predicates(self.connection.dialect, self.hash_column, self.hash_partitions)
        url, name = options.pop("url"), options.pop("dbtable")
        return spark.read.jdbc(url, name, predicates=predicates, properties=options)

    def count_load(self, spark: SparkSession, load_id: int, load_col: str) -> int:
        """Rows of a load, counted by the database."""
        statement = f"SELECT count(*) AS n FROM {self.table} WHERE {load_col} = {int(load_id)}"
        return int(spark.read.format("jdbc").options(**jdbc_options(self.connection, statement, statement=True)).load().first()[0])

    def append(self, df: DataFrame) -> None:
        df.write.format("jdbc").mode("append").options(**jdbc_write_options(self.connection, self.table)).save()

    def overwrite(self, df: DataFrame) -> None:
        options = {**jdbc_write_options(self.connection, self.table), "truncate": "true"}
        df.write.format("jdbc").mode("overwrite").options(**options).save()

    def drop_load(self, spark: SparkSession, load_id: int, load_col: str) -> bool:
        return False


Target = TableTarget | PathTarget | CommittedTarget | JdbcTarget


def _as_type(column, field: T.StructField):
    return column.cast(field.dataType).alias(field.name)


def count_load(spark: SparkSession, target: Target, load_id: int, load_col: str = LOAD_COLUMN) -> int:
    """Rows of a load in the target."""
    if isinstance(target, JdbcTarget | CommittedTarget):
        return target.count_load(spark, load_id, load_col)
    return target.read(spark).where(F.col(load_col) == F.lit(load_id)).count()


def append_by_name(df: DataFrame, target: Target) -> None:
    """Append the columns of `df` to the target's columns of the same name, in upper or lower case.

    Target columns that `df` lacks become NULL; a column the target lacks is an error.
    """
    schema = target.columns(df.sparkSession)
    given = {c.lower(): c for c in df.columns}
    for side, names in (("batch", df.columns), ("target", schema.names)):
        if len({c.lower() for c in names}) < len(names):
            raise ValueError(f"the {side} has columns that differ in upper and lower case only")
    unknown = sorted(set(given) - {c.lower() for c in schema.names})
    if unknown:
        raise ValueError(f"the target has no columns {unknown}")
    target.append(df.select(*[
        _as_type(F.col(f"`{given[f.name.lower()]}`") if f.name.lower() in given else F.lit(None), f)
        for f in schema.fields
    ]))


def append_by_position(df: DataFrame, target: Target) -> None:
    """Append the columns of `df` in their order, whatever their names; the counts must agree."""
    schema = target.columns(df.sparkSession)
    if len(df.columns) != len(schema.fields):
        raise ValueError(f"the batch has {len(df.columns)} columns, the target {len(schema.fields)}")
    numbered = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    target.append(numbered.select(*[_as_type(F.col(f"_{i}"), f) for i, f in enumerate(schema.fields)]))


def delete_load(spark: SparkSession, target: Target, load_id: int, load_col: str = LOAD_COLUMN) -> None:
    """Delete the rows of one load.

    In a target partitioned by the load id this drops one partition, and a target with lists of committed loads
    rewrites the files that hold the load. In any other, the remaining rows
    are written beside it first and then replace it, since files cannot be edited in place; that copy is
    kept in the shared folder if replacing them fails.
    """
    if not target.exists(spark) or target.drop_load(spark, load_id, load_col):
        return
    if isinstance(target, JdbcTarget):
        raise ValueError("delete the load in the database: Spark's JDBC writer cannot delete rows")
    with landed(without_load(target.read(spark), load_id, load_col), "delete-load") as rest:
        target.overwrite(rest.select(*target.columns(spark).names))


def truncate(spark: SparkSession, target: Target) -> None:
    """Remove all rows and keep the definition."""
    if isinstance(target, TableTarget):
        target.truncate(spark)
    else:
        target.overwrite(empty_frame(spark, target.columns(spark)))
