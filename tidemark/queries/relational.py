"""Queries of scans, projections, filters, joins, aggregations, sorts and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import as_timestamp
from tidemark.functions.decoding import decode_lookup
from tidemark.operators.membership import rows_in
from tidemark.operators.numbering import global_row_number
from tidemark.operators.profile import count_rows, describe_columns, null_profile, view_profile
from tidemark.operators.projection import active_at, constant_columns, not_in, positional_columns, project_rename
from tidemark.plans.feeds.survey import survey_rows
from tidemark.queries.frames import (
    AS_OF,
    SQL_AS_OF,
    SQL_RESIDENTS_VIEW,
    SQL_SURVEY_CTES,
    residents_view,
    survey_asset,
    survey_union,
)
from tidemark.queries.registry import query, table
from tidemark.sinks.schema import mapped
from tidemark.sources import ParquetSource, SqlSource, read_source

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]

# The columns of each table, for the SQL side of the profile.
TABLE_COLUMNS = {
    "region": "r_regionkey, r_name",
    "nation": "n_nationkey, n_name, n_regionkey",
    "customer": "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment",
    "supplier": "s_suppkey, s_name, s_nationkey, s_acctbal",
    "part": "p_partkey, p_name, p_brand, p_type, p_size, p_retailprice",
    "orders": "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority",
    "lineitem": "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
                "l_returnflag, l_linestatus, l_shipdate",
    "events": "event_id, ts, user_id, event_type, value, props",
    "documents": "doc_id, text, lang, source, n_chars",
    "embeddings": "vec_id, embedding, label",
    "pages": "page_id, url, html",
    "benchmark": "item_id, text",
    "labels": "doc_id, quality, toxic",
    "conversations": "conv_id, turn, role, text",
}


# --- scans and catalogue -------------------------------------------------------------------------

@query("SELECT * FROM lineitem")
def q_scan_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_source(spark, ParquetSource(f"{sf_dir}/lineitem.parquet"))


@query("SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem WHERE l_quantity > 45")
def q_scan_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = f"SELECT l_orderkey, l_linenumber, l_shipdate FROM parquet.`{sf_dir}/lineitem.parquet` WHERE l_quantity > 45"
    return read_source(spark, SqlSource(text))


@query("""
SELECT o_orderkey AS "0", o_custkey AS "1", o_orderstatus AS "2", o_totalprice AS "3", o_orderdate AS "4",
       o_orderpriority AS "5" FROM orders""")
def q_positional_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positional_columns(table(spark, sf_dir, "orders"))


@query("""
SELECT l_orderkey::DECIMAL(19,0) AS l_orderkey, l_partkey::DECIMAL(19,0) AS l_partkey,
       l_suppkey::DECIMAL(19,0) AS l_suppkey, * EXCLUDE (l_orderkey, l_partkey, l_suppkey) FROM lineitem""")
def q_schema_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapped(table(spark, sf_dir, "lineitem"))


@query(f"""
WITH described AS (SELECT * FROM (DESCRIBE SELECT * FROM ({SQL_RESIDENTS_VIEW})))
SELECT (row_number() OVER () - 1)::INTEGER AS ordinal, column_name,
       CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
            WHEN 'DOUBLE' THEN 'double' WHEN 'BOOLEAN' THEN 'boolean' END AS data_type
FROM described""")
def q_describe_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe_columns(residents_view(spark, sf_dir)).select("ordinal", "column_name", "data_type")


@query(f"""
WITH residents AS ({SQL_RESIDENTS_VIEW}),
counts AS (UNPIVOT (SELECT count(*) - count(COLUMNS(*)) FROM residents) ON COLUMNS(*) INTO NAME column_name VALUE nulls)
SELECT column_name, nulls FROM counts""")
def q_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_profile(residents_view(spark, sf_dir))


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS view_name, count(*) AS row_count, {columns.count(',') + 1} AS column_count, "
    f"'{columns}' AS column_names FROM {name}"
    for name, columns in TABLE_COLUMNS.items()
))
def q_view_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view_profile({name: table(spark, sf_dir, name) for name in TABLES})


@query("SELECT count(*) AS row_count FROM lineitem")
def q_count_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_rows(table(spark, sf_dir, "lineitem"))


# --- projections and filters ---------------------------------------------------------------------

@query("SELECT p_partkey AS UNITS_ID, p_name AS PROPERTY_NAME, p_size + 1 AS FLOORS FROM part")
def q_project_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {"UNITS_ID": "p_partkey", "PROPERTY_NAME": "p_name", "FLOORS": F.col("p_size") + 1}
    return project_rename(table(spark, sf_dir, "part"), columns)


@query("""
SELECT *, 'Supplier' AS B_CLASSNAME, 41 AS F_SOURCE_SYSTEM, '41' AS F_SOURCE_SYSTEM_TEXT FROM supplier""")
def q_constant_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constant_columns(
        table(spark, sf_dir, "supplier"),
        B_CLASSNAME="Supplier", F_SOURCE_SYSTEM=41, F_SOURCE_SYSTEM_TEXT="41",
    )


@query("""
SELECT p_partkey, p_type || '  ' AS p_type FROM part
WHERE p_brand <> 'Brand#4' AND rtrim(p_type || '  ') NOT IN ('PROMO', 'SMALL')""")
def q_not_in_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_brand") != "Brand#4", F.concat("p_type", F.lit("  "))).alias("p_type")
    )
    return padded.where(not_in(F.col("p_type"), ["PROMO", "SMALL "]))


@query("""
SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderpriority = '1-URGENT'
WHERE o_orderkey IS NOT NULL""")
def q_is_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    joined = table(spark, sf_dir, "customer").join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.where(F.col("o_orderkey").isNotNull()).select("c_custkey", "o_orderkey")


SQL_ORDER_END = "CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 30 DAY END"


@query(f"""
SELECT o_orderkey, o_orderdate AS start_date, {SQL_ORDER_END} AS end_date FROM orders
WHERE {SQL_AS_OF} BETWEEN o_orderdate AND coalesce({SQL_ORDER_END}, {SQL_AS_OF})""")
def q_active_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate") + F.expr("INTERVAL 30 DAY"))
    intervals = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("start_date"), end.alias("end_date")
    )
    return intervals.where(active_at(as_timestamp(AS_OF), F.col("start_date"), F.col("end_date")))


# --- joins ---------------------------------------------------------------------------------------

@query("""
SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer JOIN orders ON c_custkey = o_custkey""")
def q_inner_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey")
    )
    return joined.select("c_custkey", "c_name", "o_orderkey", "o_totalprice")


@query("""
SELECT o_orderkey, c_name, n_name FROM orders
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
def q_join_chain3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "c_name", "n_name")
    )


@query("""
SELECT c_custkey, n_name, o_orderkey FROM customer JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN (SELECT * FROM orders WHERE o_totalprice > 400000) ON c_custkey = o_custkey""")
def q_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = table(spark, sf_dir, "orders").where(F.col("o_totalprice") > 400000)
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(large, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select("c_custkey", "n_name", "o_orderkey")
    )


@query("""
SELECT c_custkey, c_name FROM customer
WHERE EXISTS (SELECT 1 FROM orders JOIN lineitem ON o_orderkey = l_orderkey
              WHERE o_custkey = c_custkey AND l_quantity >= 50 AND o_orderstatus = 'F')""")
def q_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    bulk = table(spark, sf_dir, "lineitem").where(F.col("l_quantity") >= 50)
    finished = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    buyers = rows_in(finished, bulk, {"o_orderkey": "l_orderkey"})
    return rows_in(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), buyers, {"c_custkey": "o_custkey"})


@query("""
SELECT c_custkey, c_name FROM customer
WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 490000)
   OR EXISTS (SELECT 1 FROM orders JOIN lineitem ON o_orderkey = l_orderkey
              WHERE o_custkey = c_custkey AND l_discount >= 0.1 AND l_quantity = 1)""")
def q_exists_or_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    large = orders.where(F.col("o_totalprice") > 490000).select("o_custkey")
    lines = table(spark, sf_dir, "lineitem").where((F.col("l_discount") >= 0.1) & (F.col("l_quantity") == 1))
    cheap = rows_in(orders, lines, {"o_orderkey": "l_orderkey"}).select("o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return rows_in(customer, large.unionByName(cheap), {"c_custkey": "o_custkey"})


@query("""
SELECT c.*, coalesce(n_name, 'UNKNOWN') AS nation_code
FROM customer c LEFT JOIN (SELECT * FROM nation WHERE n_regionkey IN (1, 2)) ON c_nationkey = n_nationkey""")
def q_decode_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lookup = table(spark, sf_dir, "nation").where(F.col("n_regionkey").isin(1, 2))
    return decode_lookup(
        table(spark, sf_dir, "customer"), lookup, "n_nationkey", "n_name", "nation_code",
        on="c_nationkey", default="UNKNOWN",
    )


# --- aggregation, numbering, sorting, union ------------------------------------------------------

@query(f"WITH {SQL_SURVEY_CTES} SELECT DISTINCT ComponentID, Component, RepairElement FROM survey")
def q_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey_union(spark, sf_dir).select("ComponentID", "Component", "RepairElement").distinct()


@query(f"""WITH {SQL_SURVEY_CTES}
SELECT ComponentID, AssetID, RepairElement, Component, Surveyor, max(RepairElementID) AS RepairElementID,
       max(Attribute) AS Attribute, max(InstallationDate) AS InstallationDate, max(Quantity) AS Quantity,
       max(coalesce(SurveyAttributeID, SurveyRepairID)) AS SurveyAttributeID
FROM survey GROUP BY ALL""")
def q_group_multi_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    findings = survey_union(spark, sf_dir)
    return findings.groupBy("ComponentID", "AssetID", "RepairElement", "Component", "Surveyor").agg(
        F.max("RepairElementID").alias("RepairElementID"),
        F.max("Attribute").alias("Attribute"),
        F.max("InstallationDate").alias("InstallationDate"),
        F.max("Quantity").alias("Quantity"),
        F.max(F.coalesce("SurveyAttributeID", "SurveyRepairID")).alias("SurveyAttributeID"),
    )


@query("""
SELECT row_number() OVER (ORDER BY l_partkey, l_suppkey, l_orderkey, l_linenumber, l_quantity, l_extendedprice,
         l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS line_number, * FROM lineitem""")
def q_global_row_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return global_row_number(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"], "line_number")


@query("SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def q_limit_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query(f"WITH {SQL_SURVEY_CTES} SELECT * FROM survey")
def q_union_all_padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey_rows(survey_asset(spark, sf_dir), survey_union(spark, sf_dir))
