"""Queries that write a table, change it and read it back.

Each run writes to a fresh folder below the shared folder of the session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.projection import stamp_load_id
from tidemark.plans.run import run_feeds
from tidemark.queries.frames import SQL_ORDER_BATCH, SQL_ORDER_OPENING, order_batch, order_opening
from tidemark.queries.registry import query, table
from tidemark.sinks import PathTarget, append_by_name, append_by_position, delete_load, truncate
from tidemark.specs import FeedSpec
from tidemark.workspace import new_path


def _target(spark: SparkSession, schema: T.StructType, label: str, partition_by: tuple[str, ...] = ()) -> PathTarget:
    return PathTarget(new_path(spark, label), schema, partition_by)


def _split_loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The finished orders as load 1, all others as load 2."""
    orders = table(spark, sf_dir, "orders")
    finished = F.col("o_orderstatus") == "F"
    return stamp_load_id(orders.where(finished), 1), stamp_load_id(orders.where(~finished), 2)


SQL_LOADS = "SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END::BIGINT AS B_LOADID, * FROM orders"


@query(f"SELECT * EXCLUDE (o_totalprice), CASE WHEN B_LOADID = 1 THEN o_totalprice END AS o_totalprice FROM ({SQL_LOADS})")
def q_append_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _split_loads(spark, sf_dir)
    target = _target(spark, first.schema, "append-by-name", ("B_LOADID",))
    append_by_name(first, target)
    append_by_name(second.drop("o_totalprice").select("o_orderstatus", *[
        c for c in second.columns if c not in ("o_orderstatus", "o_totalprice")
    ]), target)
    return target.read(spark)


@query(SQL_LOADS)
def q_append_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _split_loads(spark, sf_dir)
    target = _target(spark, first.schema, "append-by-position")
    append_by_position(first, target)
    append_by_position(second.toDF(*[str(i) for i in range(len(second.columns))]), target)
    return target.read(spark)


SQL_YEARS = "SELECT year(o_orderdate)::BIGINT AS B_LOADID, * FROM orders"


@query(f"SELECT * FROM ({SQL_YEARS}) WHERE B_LOADID <> 1998")
def q_delete_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_year = stamp_load_id(table(spark, sf_dir, "orders"), F.year("o_orderdate"))
    target = _target(spark, by_year.schema, "delete-load", ("B_LOADID",))
    append_by_name(by_year, target)
    delete_load(spark, target, 1998)
    return target.read(spark)


@query(f"""
SELECT CASE WHEN B_LOADID <> 1999 THEN B_LOADID END AS B_LOADID, * EXCLUDE (B_LOADID)
FROM ({SQL_YEARS}) WHERE B_LOADID <> 1998""")
def q_delete_load_unpartitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without partitions, and with rows that have no load id, which stay."""
    year = F.year("o_orderdate")
    by_year = stamp_load_id(table(spark, sf_dir, "orders"), F.when(year != 1999, year))
    target = _target(spark, by_year.schema, "delete-load")
    append_by_name(by_year, target)
    delete_load(spark, target, 1998)
    return target.read(spark)


@query("SELECT count(*) AS rows_before, 0::BIGINT AS rows_after FROM orders")
def q_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    target = _target(spark, orders.schema, "truncate")
    append_by_name(orders, target)
    before = target.read(spark).count()
    truncate(spark, target)
    return target.read(spark).agg(
        F.lit(before).cast("bigint").alias("rows_before"), F.count(F.lit(1)).alias("rows_after")
    )


AUDIT_COLUMNS = ["target_table", "company", "hierarchy", "load_id", "retrieved", "inserted", "columns", "status"]


@query(f"""
WITH opening AS ({SQL_ORDER_OPENING}), batch AS ({SQL_ORDER_BATCH})
SELECT 'SA_ORDERS' AS target_table, 'first' AS company, 2 AS hierarchy, 102::BIGINT AS load_id,
       (SELECT count(*) FROM opening) AS retrieved, (SELECT count(*) FROM opening) AS inserted, 8 AS columns,
       'loaded' AS status
UNION ALL
SELECT 'SA_ORDERS', 'second', 3, 103, (SELECT count(*) FROM batch),
       (SELECT count(*) FROM batch WHERE HASH_VALUE NOT IN (SELECT HASH_VALUE FROM opening)), 8, 'loaded'
UNION ALL
SELECT 'SA_ORDERS', 'third', 4, 104, (SELECT count(*) FROM batch), 0, 8, 'empty'
UNION ALL
SELECT 'SA_CUSTOMER', 'first', 1, 101, (SELECT count(*) FROM customer), (SELECT count(*) FROM customer), 4, 'loaded'
UNION ALL
SELECT 'SA_SUPPLIER', 'first', 5, 105, NULL, NULL, NULL, 'failed'""")
def q_load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run of five feeds with three targets; one batch has no hash, so its feed fails and the others go on."""
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.md5(F.concat_ws("|", F.col("c_custkey").cast("string"), "c_name")).alias("HASH_VALUE")
    )
    batches = {
        1: customer,
        2: order_opening(spark, sf_dir),
        3: order_batch(spark, sf_dir),
        4: order_batch(spark, sf_dir),
        5: table(spark, sf_dir, "supplier"),
    }
    specs = [
        FeedSpec("SA_ORDERS", "first", 2, "ORDERS_ID"),
        FeedSpec("SA_ORDERS", "second", 3, "ORDERS_ID"),
        FeedSpec("SA_ORDERS", "third", 4, "ORDERS_ID"),
        FeedSpec("SA_CUSTOMER", "first", 1, "c_custkey"),
        FeedSpec("SA_SUPPLIER", "first", 5, "s_suppkey"),
    ]
    targets = {}
    for spec in specs:
        schema = stamp_load_id(batches[spec.hierarchy], 0).schema
        targets.setdefault(spec.target_table, _target(spark, schema, spec.target_table, ("B_LOADID",)))
    audit = run_feeds(
        spark, specs,
        read=lambda spec: batches[spec.hierarchy],
        target=lambda spec: targets[spec.target_table],
        load_id=lambda spec: 100 + spec.hierarchy,
        # The tables are files that do not change, so one feed lands for the sake of the trial only.
        land=lambda spec: spec.company == "second",
    )
    return audit.select(*AUDIT_COLUMNS)
