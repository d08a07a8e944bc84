"""Queries of the column expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.cleaning import (
    blank_to_null,
    concat_key,
    equals_padded,
    isnull_default,
    nan_to_null,
    rtrim_text,
)
from tidemark.functions.dates import (
    format_twelve_hour,
    parse_oracle_date,
    text_to_date,
    validity_window,
)
from tidemark.functions.decoding import decode, decode_like, decode_rank
from tidemark.functions.hashing import hash_to_string, row_hash, sha1_null_marked, sha1_null_skipped, zone_free
from tidemark.queries.frames import oracle_text, sql_morning
from tidemark.queries.registry import query, table


@query("""
SELECT o_orderkey, coalesce(nullif(o_orderpriority, '4-NOT SPECIFIED'), '') AS priority,
       CASE WHEN o_orderstatus <> 'F' THEN o_custkey ELSE 0 END AS customer,
       CASE WHEN o_orderstatus = 'O' THEN o_orderdate::DATE ELSE DATE '1900-01-01' END AS due
FROM orders""")
def q_isnull_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        isnull_default(F.when(priority != "4-NOT SPECIFIED", priority)).alias("priority"),
        isnull_default(F.when(status != "F", F.col("o_custkey")), "bigint").alias("customer"),
        isnull_default(F.when(status == "O", F.col("o_orderdate").cast("date")), "date").alias("due"),
    )


@query("""
SELECT * REPLACE (CASE WHEN l_returnflag <> 'N' THEN l_quantity END AS l_quantity,
                  CASE WHEN l_linestatus <> 'O' THEN l_extendedprice END AS l_extendedprice,
                  CASE WHEN l_linenumber <> 2 THEN l_discount END AS l_discount,
                  CASE WHEN l_linenumber <> 3 THEN l_tax END AS l_tax)
FROM lineitem""")
def q_nan_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    nan_where = lambda condition, c: F.when(condition, F.lit(float("nan"))).otherwise(F.col(c))
    return nan_to_null(table(spark, sf_dir, "lineitem").withColumns({
        "l_quantity": nan_where(F.col("l_returnflag") == "N", "l_quantity"),
        "l_extendedprice": nan_where(F.col("l_linestatus") == "O", "l_extendedprice"),
        "l_discount": nan_where(F.col("l_linenumber") == 2, "l_discount"),
        "l_tax": nan_where(F.col("l_linenumber") == 3, "l_tax"),
    }))


@query("SELECT p_partkey, 'TP_' || CASE WHEN p_type <> 'PROMO' THEN p_size::VARCHAR END AS type_key FROM part")
def q_concat_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.when(F.col("p_type") != "PROMO", F.col("p_size"))
    return table(spark, sf_dir, "part").select("p_partkey", concat_key("TP_", size).alias("type_key"))


@query("""
SELECT p_partkey, sha256(p_partkey::VARCHAR || chr(31) || p_name || chr(31)
         || coalesce(nullif(p_type, 'PROMO'), chr(30)) || chr(31) || p_size::VARCHAR || chr(31)
         || strftime(TIMESTAMP '2001-01-01' + to_days(p_size), '%Y-%m-%d %H:%M:%S')) AS HASH_VALUE
FROM part""")
def q_row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("p_type") != "PROMO", F.col("p_type"))
    changed = F.timestamp_seconds(F.lit(978307200) + F.col("p_size") * 86400)  # an instant, with a zone
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name", kind.alias("kind"), "p_size", changed.alias("changed"))
    return zone_free(rows).select(
        "p_partkey", row_hash("p_partkey", "p_name", "kind", "p_size", "changed").alias("HASH_VALUE")
    )


@query("""
SELECT p_partkey, sha1(p_name || coalesce(nullif(p_type, 'PROMO'), 'NA') || p_brand) AS HASH_VALUE FROM part""")
def q_row_hash_sha1(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("p_type") != "PROMO", F.col("p_type"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", sha1_null_marked("p_name", kind, "p_brand").alias("HASH_VALUE")
    )


@query("""
SELECT c_custkey, sha1(c_name || coalesce(nullif(c_mktsegment, 'BUILDING'), '') || c_nationkey::VARCHAR) AS HASH_VALUE
FROM customer""")
def q_row_hash_oracle(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", sha1_null_skipped("c_name", segment, "c_nationkey").alias("HASH_VALUE")
    )


@query("SELECT o_orderkey, md5(o_orderkey::VARCHAR) AS HASH_VALUE FROM orders")
def q_hash_to_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    binary = F.unhex(F.md5(F.col("o_orderkey").cast("string")))
    return hash_to_string(table(spark, sf_dir, "orders").select("o_orderkey", binary.alias("HASH_VALUE")))


@query("SELECT event_id, ts - INTERVAL 1 DAY AS VALID_FROM, ts + INTERVAL 100 MONTH AS VALID_TO FROM events")
def q_validity_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = validity_window(F.col("ts"))
    return table(spark, sf_dir, "events").select("event_id", start.alias("VALID_FROM"), end.alias("VALID_TO"))


@query(f"""
SELECT event_id, CASE WHEN event_type <> 'error' THEN {sql_morning("ts")} END AS parsed FROM events""")
def q_parse_oracle_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    text = (
        F.when(kind == "error", F.concat(F.lit("no date: "), F.col("props")))
        .when(kind == "click", oracle_text("ts", 2))
        .when(kind == "view", F.initcap(oracle_text("ts")))
        .otherwise(oracle_text("ts"))
    )
    return table(spark, sf_dir, "events").select("event_id", parse_oracle_date(text).alias("parsed"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %I:%M:%S') AS created FROM events")
def q_format_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", format_twelve_hour(F.col("ts")).alias("created"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN DATE '1900-01-01'
         WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN NULL ELSE o_orderdate::DATE END AS due,
       o_custkey::VARCHAR AS customer
FROM orders""")
def q_clean_text_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    text = (
        F.when(priority == "1-URGENT", F.lit("   "))
        .when(priority == "3-MEDIUM", F.lit("soon  "))
        .when(priority == "2-HIGH", F.lit(None))
        .when(F.col("o_orderkey") % 4 == 0, F.date_format("o_orderdate", "yyyyMMdd"))
        .when(F.col("o_orderkey") % 4 == 1, F.date_format("o_orderdate", "d MMM yyyy"))
        .when(F.col("o_orderkey") % 4 == 2, F.concat(F.date_format("o_orderdate", "MMM d yyyy"), F.lit(" 12:00AM")))
        .otherwise(F.concat(F.col("o_orderdate").cast("date").cast("string"), F.lit("    ")))
    )
    customer = F.concat(F.col("o_custkey").cast("string"), F.lit("   "))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", text_to_date(text).alias("due"), rtrim_text(customer).alias("customer")
    )


@query("""
SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 1 ELSE 21 END AS contractor, nullif(p_type, 'SMALL') AS team FROM part""")
def q_iif_nullif(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat("p_type", F.lit("   "))
    team = F.when(F.col("p_type") == "SMALL", F.lit("  ")).otherwise(F.col("p_type"))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(equals_padded(padded, "PROMO"), F.lit(1)).otherwise(F.lit(21)).alias("contractor"),
        blank_to_null(team).alias("team"),
    )


@query("""
SELECT o_orderkey,
       CASE o_orderstatus WHEN 'O' THEN '022' WHEN 'F' THEN '004' ELSE '000' END AS occupancy,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN '001' WHEN '5' THEN '000' ELSE '002' END AS precedence,
       CASE o_orderpriority WHEN '3-MEDIUM' THEN 'M' WHEN '5-LOW' THEN 'L' ELSE 'X' END AS channel
FROM orders""")
def q_case_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.substring("o_orderpriority", 1, 1)
    precedence = F.when(first == "5", F.lit("none")).otherwise(first)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        decode_like(F.col("o_orderstatus"), {"O": "022", "F": "004"}, "000").alias("occupancy"),
        decode_rank(precedence, "001", "002", "000").alias("precedence"),
        decode(F.col("o_orderpriority"), {"3-MEDIUM": "M", "5-LOW": "L"}, "X").alias("channel"),
    )
