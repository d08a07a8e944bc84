"""Sources: JDBC databases, parquet folders, catalogue tables and SQL text."""

from tidemark.sources.jdbc import JdbcConnection, hash_predicates, jdbc_options, range_partitioning
from tidemark.sources.readers import (
    JdbcSource,
    ParquetSource,
    SqlSource,
    TableSource,
    connection_for,
    list_tables,
    read_source,
    source_for,
)

__all__ = [
    "JdbcConnection",
    "JdbcSource",
    "ParquetSource",
    "SqlSource",
    "TableSource",
    "connection_for",
    "hash_predicates",
    "jdbc_options",
    "list_tables",
    "range_partitioning",
    "read_source",
    "source_for",
]
