"""Every registered query against its SQL in DuckDB, over whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as spark_entry
from tidemark.queries import QUERIES
from tests.compare import difference, open_tables

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return open_tables(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(spark_entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    df = spark_entry.queries()[name](spark, SF_DIR)
    assert difference(df, spark_entry.oracle_sql()[name], connection) is None


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
