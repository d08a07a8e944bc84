"""Reading a feed's source as a DataFrame."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.jdbc import JdbcConnection, hash_predicates, jdbc_options, range_partitioning
from tidemark.specs import FeedSpec


@dataclass(frozen=True)
class JdbcSource:
    """A statement, view or table of a database.

    Reads through one connection unless it is told how to split: by `partitioning` (see
    `range_partitioning`), or by the hash of `hash_column`. Each part of a hash split runs the statement anew, so for
    an expensive view ranges over an indexed column are better. `statement` says whether the text is a statement or
    a name, where that is not plain from its first word.
    """

    connection: JdbcConnection
    query_or_table: str
    partitioning: Mapping[str, str] | None = None
    hash_column: str | None = None
    hash_partitions: int = 32
    statement: bool | None = None


@dataclass(frozen=True)
class ParquetSource:
    path: str


@dataclass(frozen=True)
class TableSource:
    name: str


@dataclass(frozen=True)
class SqlSource:
    """SQL text over the session's own tables and views."""

    text: str


Source = JdbcSource | ParquetSource | TableSource | SqlSource


def read_source(spark: SparkSession, source: Source) -> DataFrame:
    """The source as a lazy DataFrame."""
    if isinstance(source, JdbcSource):
        return _read_jdbc(spark, source)
    if isinstance(source, ParquetSource):
        return spark.read.parquet(source.path)
    if isinstance(source, TableSource):
        return spark.table(source.name)
    if isinstance(source, SqlSource):
        return spark.sql(source.text)
    raise ValueError(f"unknown source {source!r}")


def _read_jdbc(spark: SparkSession, source: JdbcSource) -> DataFrame:
    options = jdbc_options(source.connection, source.query_or_table, partitioning=source.partitioning, statement=source.statement)
    if source.hash_column is None:
        return spark.read.format("jdbc").options(**options).load()
    predicates = hash_predicates(source.connection.dialect, source.hash_column, source.hash_partitions)
    url, table = options.pop("url"), options.pop("dbtable")
    return spark.read.jdbc(url, table, predicates=predicates, properties=options)


def connection_for(company: str, connections: Mapping[str, JdbcConnection]) -> JdbcConnection:
    """The company's database; a company without one is an error."""
    try:
        return connections[company]
    except KeyError:
        raise ValueError(f"no source database for company {company!r}; known are {sorted(connections)}") from None


def source_for(spec: FeedSpec, connections: Mapping[str, JdbcConnection]) -> JdbcSource:
    """The database source of a feed, by its company; server and database of the feed override the defaults."""
    base = connection_for(spec.company, connections)
    if spec.statement is None:
        raise ValueError(f"feed {spec.label} has no statement")
    connection = JdbcConnection(
        base.dialect, spec.server or base.host, spec.source_database or base.database, base.port, base.options
    )
    if spec.split_column is None:
        return JdbcSource(connection, spec.statement)
    if spec.split_lower is None or spec.split_upper is None:
        return JdbcSource(connection, spec.statement, hash_column=spec.split_column, hash_partitions=spec.split_parts)
    ranges = range_partitioning(spec.split_column, spec.split_lower, spec.split_upper, spec.split_parts)
    return JdbcSource(connection, spec.statement, partitioning=ranges)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables and views of the catalogue as rows `owner, table_name, is_view`."""
    views = [
        (".".join(t.namespace or []), t.name, t.tableType in ("VIEW", "TEMPORARY"))
        for t in spark.catalog.listTables(database)
    ]
    return spark.createDataFrame(views, "owner string, table_name string, is_view boolean").orderBy(
        F.col("owner"), F.col("table_name")
    )
