"""Options for Spark's JDBC source. Pure functions: nothing here opens a connection."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

# Driver classes and URL forms of the two databases.
DRIVERS = {
    "sqlserver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "oracle": "oracle.jdbc.OracleDriver",
}
URLS = {
    "sqlserver": "jdbc:sqlserver://{host}:{port};databaseName={database}",
    "oracle": "jdbc:oracle:thin:@//{host}:{port}/{database}",
}
PORTS = {"sqlserver": 1433, "oracle": 1521}

FETCH_SIZE = 10_000
BATCH_SIZE = 10_000


@dataclass(frozen=True)
class JdbcConnection:
    """A database; for Oracle, `database` is the service name. Credentials go into `options`."""

    dialect: str
    host: str
    database: str
    port: int | None = None
    options: Mapping[str, str] = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        if self.dialect not in DRIVERS:
            raise ValueError(f"unknown database kind {self.dialect!r}; known are {sorted(DRIVERS)}")

    def base_options(self) -> dict[str, str]:
        port = self.port or PORTS[self.dialect]
        url = URLS[self.dialect].format(host=self.host, port=port, database=self.database)
        return {"url": url, "driver": DRIVERS[self.dialect], **self.options}


_COMMENTS = re.compile(r"\s*(?:--[^\n]*(?:\n|\Z)|/\*.*?\*/)", re.S)


def without_leading_comments(text: str) -> str:
    text = text.strip()
    while m := _COMMENTS.match(text):
        text = text[m.end():].strip()
    return text.rstrip("; \n\t")


def is_statement(text: str) -> bool:
    """Whether the text is a SELECT or WITH statement and not the name of a table or view."""
    return re.match(r"(?:select|with)\b(?!\s*\.)[\s(*]", without_leading_comments(text) + " ", re.I) is not None and (
        len(without_leading_comments(text).split(None, 1)) > 1)


def split_with(statement: str) -> tuple[str, str]:
    """The WITH part of a statement, empty if it has none, and its main SELECT."""
    text = without_leading_comments(statement)
    if not re.match(r"with\b", text, re.I):
        return "", text
    depth, at = 0, 0
    token = re.compile(r"'(?:[^']|'')*'|\"[^\"]*\"|\[[^\]]*\]|--[^\n]*|/\*.*?\*/|[()]|\bselect\b", re.S | re.I)
    for m in token.finditer(text):
        depth += {"(": 1, ")": -1}.get(m[0], 0)
        if depth == 0 and m[0].lower() == "select":
            at = m.start()
            break
    return text[:at].strip(), text[at:]


def _relation(dialect: str, query_or_table: str, statement: bool | None) -> dict[str, str]:
    text = without_leading_comments(query_or_table)
    if not (is_statement(text) if statement is None else statement):
        return {"dbtable": text}
    prepare, select = split_with(text) if dialect == "sqlserver" else ("", text)
    return {"dbtable": f"({select}) src", **({"prepareQuery": prepare} if prepare else {})}


def range_partitioning(column: str, lower: int | str, upper: int | str, partitions: int) -> dict[str, str]:
    """Read in parallel by ranges of a number, date or timestamp column whose values are spread evenly."""
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def hash_predicates(dialect: str, column: str, partitions: int) -> list[str]:
    """WHERE conditions that split a table by the hash of a column, for text keys or uneven ranges.

    Every row, also one with a NULL in the column, meets exactly one condition.
    """
    if dialect == "oracle":
        return [f"ORA_HASH({column}, {partitions - 1}) = {i}" for i in range(partitions)]
    if dialect == "sqlserver":
        return [f"(CHECKSUM({column}) & 2147483647) % {partitions} = {i}" for i in range(partitions)]
    raise ValueError(f"unknown database kind {dialect!r}")


def jdbc_options(
    connection: JdbcConnection,
    query_or_table: str,
    *,
    partitioning: Mapping[str, str] | None = None,
    fetch_size: int = FETCH_SIZE,
    statement: bool | None = None,
) -> dict[str, str]:
    """Options of `spark.read.format("jdbc")` for a statement or a table.

    `statement` says which it is; without it, text that begins with the word SELECT or WITH, after any comments, and
    goes on is a statement. A statement becomes a derived table, so Spark's column pruning and filter pushdown reach
    the database, and the read can be partitioned. SQL Server takes no WITH there, so that part goes ahead of it. Times
    are read without a zone, so that nothing depends on the session's.
    """
    return {
        **connection.base_options(),
        **_relation(connection.dialect, query_or_table, statement),
        "fetchsize": str(fetch_size),
        "preferTimestampNTZ": "true",
        **(partitioning or {}),
    }


def jdbc_write_options(connection: JdbcConnection, table: str, *, batch_size: int = BATCH_SIZE) -> dict[str, str]:
    """Options of `df.write.format("jdbc")`."""
    return {**connection.base_options(), "dbtable": table, "batchsize": str(batch_size)}
