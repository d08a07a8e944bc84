"""Queries of the incremental load: versions, hash comparison, load ids, counts and promotion."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.projection import stamp_load_id
from tidemark.operators.screening import screened_rows_not_in
from tidemark.operators.versions import hash_anti_join, latest_per_key, next_load_id
from tidemark.plans.current import CurrentVersions
from tidemark.plans.load import incremental_load, incremental_rows, load_counts
from tidemark.plans.promote import promotion_manifest
from tidemark.queries.frames import (
    OPENING_CUT,
    RELOADED,
    SQL_FEED_ROWS,
    SQL_LATEST,
    SQL_ORDER_BATCH,
    SQL_ORDER_HISTORY,
    feed_rows,
    order_batch,
    order_history,
    order_opening,
)
from tidemark.queries.registry import query, table
from tidemark.sinks import CommittedTarget, TableTarget, append_by_name, delete_load
from tidemark.specs import feed_counts, select_feeds
from tidemark.workspace import new_path

SQL_BATCH_AND_LATEST = f"""
WITH batch AS ({SQL_ORDER_BATCH}), history AS ({SQL_ORDER_HISTORY}), latest AS ({SQL_LATEST})"""


@query(f"""{SQL_BATCH_AND_LATEST}
SELECT 3::BIGINT AS B_LOADID, b.* FROM batch b
WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.HASH_VALUE IS NOT DISTINCT FROM b.HASH_VALUE)""")
def q_incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental_rows(order_batch(spark, sf_dir), order_history(spark, sf_dir), keys="ORDERS_ID", load_id=3)


@query(f"""{SQL_BATCH_AND_LATEST}
SELECT 3::BIGINT AS B_LOADID, b.* FROM batch b
WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.HASH_VALUE = b.HASH_VALUE AND l.ORDERS_ID = b.ORDERS_ID)""")
def q_incremental_load_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental_rows(
        order_batch(spark, sf_dir), order_history(spark, sf_dir), keys="ORDERS_ID", load_id=3, match_on="key_hash"
    )


@query("""
WITH versions AS (SELECT user_id, ts::DATE AS day, event_id, event_type FROM events)
SELECT v.user_id, v.day, v.event_id, v.event_type FROM versions v
JOIN (SELECT user_id, max(day) AS day FROM versions GROUP BY user_id) g ON v.user_id = g.user_id AND v.day = g.day""")
def q_latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = table(spark, sf_dir, "events").select(
        "user_id", F.col("ts").cast("date").alias("day"), "event_id", "event_type"
    )
    return latest_per_key(versions, "user_id", "day").select("user_id", "day", "event_id", "event_type")


@query(f"WITH history AS ({SQL_ORDER_HISTORY}) {SQL_LATEST}")
def q_latest_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(order_history(spark, sf_dir), "ORDERS_ID").select("ORDERS_ID", "B_LOADID", "HASH_VALUE")


@query(f"WITH history AS ({SQL_ORDER_HISTORY}) {SQL_LATEST}")
def q_latest_hashes_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a table laid out by the key, whose rows are not moved."""
    history = order_history(spark, sf_dir).select("ORDERS_ID", "B_LOADID", "HASH_VALUE")
    target = TableTarget(f"orders_{uuid.uuid4().hex}", history.schema, bucket_by=("ORDERS_ID",), buckets=16)
    target.create(spark)
    append_by_name(history, target)
    return latest_per_key(target.read(spark), "ORDERS_ID", co_located=True)


SQL_THREE_LOADS = f"""{SQL_BATCH_AND_LATEST},
all_rows AS (
  SELECT ORDERS_ID, B_LOADID, HASH_VALUE FROM history
  UNION ALL
  SELECT ORDERS_ID, 3, HASH_VALUE FROM batch b
  WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.HASH_VALUE IS NOT DISTINCT FROM b.HASH_VALUE))"""


def three_loads(spark: SparkSession, sf_dir: str) -> CurrentVersions:
    """The opening, the finished orders of high priority and all orders, loaded one after the other."""
    batch = order_batch(spark, sf_dir)
    opened = F.col("o_orderdate") < F.lit(OPENING_CUT).cast("timestamp_ntz")
    reloaded = batch.where(opened & (F.col("o_orderstatus") == "F") & F.col("o_orderpriority").isin(*RELOADED))
    target = CommittedTarget(new_path(spark, "orders"), stamp_load_id(batch, 0).schema)
    current = CurrentVersions.of(target, "ORDERS_ID")
    for load_id, rows in enumerate([order_opening(spark, sf_dir), reloaded, batch], 1):
        incremental_load(rows, target, keys="ORDERS_ID", load_id=load_id, land=False, current=current, screened=load_id == 3)
    return current


@query(f"""{SQL_THREE_LOADS}
SELECT a.* FROM all_rows a
JOIN (SELECT ORDERS_ID, max(B_LOADID) AS B_LOADID FROM all_rows GROUP BY ORDERS_ID) g USING (ORDERS_ID, B_LOADID)""")
def q_current_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of current versions after three loads that compared with it."""
    return three_loads(spark, sf_dir).read(spark)


@query(f"{SQL_THREE_LOADS} SELECT * FROM all_rows WHERE B_LOADID <> 2")
def q_committed_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history of three loads in a target with lists of loads, the second one deleted."""
    target = three_loads(spark, sf_dir).target
    delete_load(spark, target, 2)
    return target.read(spark).select("ORDERS_ID", "B_LOADID", "HASH_VALUE")


SQL_NULL_HASHES = f"""
WITH batch AS (
  SELECT ORDERS_ID, o_orderpriority,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN HASH_VALUE END AS HASH_VALUE FROM ({SQL_ORDER_BATCH})),
seen AS (
  SELECT CASE WHEN B_LOADID = 1 THEN HASH_VALUE END AS HASH_VALUE FROM ({SQL_ORDER_HISTORY}))"""


@query(f"""{SQL_NULL_HASHES}
SELECT * FROM batch b WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.HASH_VALUE IS NOT DISTINCT FROM b.HASH_VALUE)""")
def q_hash_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_anti_join(*_null_hashes(spark, sf_dir))


@query(f"""{SQL_NULL_HASHES}
SELECT * FROM batch b WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.HASH_VALUE IS NOT DISTINCT FROM b.HASH_VALUE)""")
def q_hash_anti_join_screened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows, those that are new for certain told apart by bit sets."""
    batch, seen = _null_hashes(spark, sf_dir)
    return screened_rows_not_in(batch, seen, ["HASH_VALUE"])


def _null_hashes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    batch = order_batch(spark, sf_dir).select(
        "ORDERS_ID",
        "o_orderpriority",
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("HASH_VALUE")).alias("HASH_VALUE"),
    )
    seen = order_history(spark, sf_dir).select(
        F.when(F.col("B_LOADID") == 1, F.col("HASH_VALUE")).alias("HASH_VALUE")
    )
    return batch, seen


@query("SELECT user_id, max(event_id) AS latest_event FROM events GROUP BY user_id")
def q_group_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("event_id").alias("latest_event"))


@query(f"""
WITH history AS ({SQL_ORDER_HISTORY}), empty AS (SELECT * FROM history WHERE B_LOADID < 0)
SELECT coalesce((SELECT max(B_LOADID) FROM history), (SELECT max(o_orderkey) FROM orders)) + 1 AS next_load_id
UNION ALL
SELECT coalesce((SELECT max(B_LOADID) FROM empty), (SELECT max(o_orderkey) FROM orders)) + 1""")
def q_next_load_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    history, orders = order_history(spark, sf_dir), table(spark, sf_dir, "orders")
    empty = history.where(F.col("B_LOADID") < 0)
    return next_load_id(history, orders, fallback_col="o_orderkey").unionByName(
        next_load_id(empty, orders, fallback_col="o_orderkey")
    )


@query("SELECT 7::BIGINT AS B_LOADID, * FROM orders")
def q_stamp_load_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamp_load_id(table(spark, sf_dir, "orders"), 7)


SQL_LOADS = f"""{SQL_BATCH_AND_LATEST},
marked AS (
  SELECT b.*, NOT EXISTS (SELECT 1 FROM latest l WHERE l.HASH_VALUE IS NOT DISTINCT FROM b.HASH_VALUE) AS is_new,
         substr(o_orderpriority, 1, 1)::INTEGER AS hierarchy,
         (year(o_orderdate) * 1000 + substr(o_orderpriority, 1, 1)::INTEGER * 100 + ascii(o_orderstatus))::BIGINT
           AS load_id,
         'SA_' || o_orderstatus || '_' || year(o_orderdate)::VARCHAR AS target_table
  FROM batch b),
loads AS (
  SELECT hierarchy, load_id, target_table, count(*) AS retrieved, count(*) FILTER (WHERE is_new) AS inserted
  FROM marked GROUP BY ALL)"""


def _loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch as one load per year, priority and status."""
    priority = F.substring("o_orderpriority", 1, 1).cast("int")
    batch = order_batch(spark, sf_dir).withColumns({
        "hierarchy": priority,
        "load_id": (F.year("o_orderdate") * 1000 + priority * 100 + F.ascii("o_orderstatus")).cast("bigint"),
        "target_table": F.concat(
            F.lit("SA_"), F.col("o_orderstatus"), F.lit("_"), F.year("o_orderdate").cast("string")
        ),
    })
    latest = latest_per_key(order_history(spark, sf_dir), "ORDERS_ID")
    return load_counts(batch, latest, ["hierarchy", "load_id", "target_table"])


@query(f"{SQL_LOADS} SELECT * FROM loads")
def q_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loads(spark, sf_dir)


@query(f"""{SQL_LOADS}
SELECT (row_number() OVER (ORDER BY hierarchy, load_id))::INTEGER AS seq, hierarchy, load_id,
       'SUBMIT_LOAD' AS function, 'INTEGRATE' AS job, 'loader' AS "user", target_table AS "table"
FROM loads WHERE inserted > 0""")
def q_promotion_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return promotion_manifest(_loads(spark, sf_dir), function="SUBMIT_LOAD", job="INTEGRATE", user="loader")


@query(f"""
SELECT * FROM ({SQL_FEED_ROWS})
WHERE company IN ('PROMO', 'LARGE') AND (source_database IS NULL OR source_database NOT IN ('red plate', 'hot ring'))""")
def q_feed_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_feeds(feed_rows(spark, sf_dir), ["PROMO", "LARGE"], ["red plate", "hot ring"])


@query(f"""
SELECT company, count(*) AS feeds FROM ({SQL_FEED_ROWS}) GROUP BY company
UNION ALL SELECT 'TOTAL', count(*) FROM ({SQL_FEED_ROWS})""")
def q_feed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_counts(feed_rows(spark, sf_dir))
