"""Comparison of a Spark result with a DuckDB result: columns, types and rows in any order."""

from __future__ import annotations

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]

SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def _duck_type(spark_type: str) -> str:
    return spark_type.upper() if spark_type.startswith("decimal") else SAME_TYPE[spark_type]


def difference(df, sql: str, connection) -> str | None:
    """What differs, or None."""
    result = connection.sql(sql)
    ours = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    theirs = {name: str(dtype) for name, dtype in zip(result.columns, result.types)}
    if sorted(ours) != sorted(theirs):
        return f"columns {sorted(ours)} against {sorted(theirs)}"
    types = {n: (t, theirs[n]) for n, t in ours.items() if _duck_type(t) != theirs[n]}
    if types:
        return f"types {types}"
    a = _sorted_rows(list(ours), [tuple(r) for r in df.collect()])
    b = _sorted_rows(list(theirs), result.fetchall())
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"{x} against {y}"
    return None
