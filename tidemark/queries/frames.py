"""Frames that several queries share, each as a DataFrame and as the SQL that defines the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.feeds.survey import survey_findings
from tidemark.queries.registry import table
from tidemark.workspace import folder_bytes

AS_OF = "2001-03-15 14:05:06"
SQL_AS_OF = f"TIMESTAMP '{AS_OF}'"

OPENING_CUT = "2001-01-01"
RELOADED = ("1-URGENT", "2-HIGH")


def cents(col: Column) -> Column:
    return F.round(col * 100).cast("bigint")


def money(col: str) -> Column:
    return F.col(col).cast("decimal(12,2)")


def _content(status: Column) -> Column:
    return F.md5(F.concat_ws(
        "|",
        F.col("o_custkey").cast("string"),
        status,
        cents(F.col("o_totalprice")).cast("string"),
        F.col("o_orderdate").cast("date").cast("string"),
        F.col("o_orderpriority"),
    ))


def _sql_content(status: str) -> str:
    return (
        f"md5(o_custkey::VARCHAR || '|' || {status} || '|' || round(o_totalprice * 100)::BIGINT::VARCHAR || '|' || "
        "o_orderdate::DATE::VARCHAR || '|' || o_orderpriority)"
    )


ORDER_COLUMNS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def order_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders as they are now."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ORDERS_ID"), *ORDER_COLUMNS, _content(F.col("o_orderstatus")).alias("HASH_VALUE")
    )


SQL_ORDER_BATCH = f"""
SELECT o_orderkey AS ORDERS_ID, {", ".join(ORDER_COLUMNS)}, {_sql_content("o_orderstatus")} AS HASH_VALUE
FROM orders"""


def order_opening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders as they were first loaded: up to 2000, those now finished still open."""
    was = F.when(F.col("o_orderstatus") == "F", F.lit("O")).otherwise(F.col("o_orderstatus"))
    return table(spark, sf_dir, "orders").where(F.col("o_orderdate") < F.lit(OPENING_CUT).cast("timestamp_ntz")).select(
        F.col("o_orderkey").alias("ORDERS_ID"), *ORDER_COLUMNS, _content(was).alias("HASH_VALUE")
    )


SQL_ORDER_OPENING = f"""
SELECT o_orderkey AS ORDERS_ID, {", ".join(ORDER_COLUMNS)},
       {_sql_content("CASE WHEN o_orderstatus = 'F' THEN 'O' ELSE o_orderstatus END")} AS HASH_VALUE
FROM orders WHERE o_orderdate < TIMESTAMP '{OPENING_CUT}'"""


def order_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the target holds: the opening load, then a second load of the finished orders of high priority.

    Against it, the batch has unseen orders (2001), changed ones (finished, lower priority), unchanged
    ones, and some whose opening version is superseded.
    """
    status = F.col("o_orderstatus")
    version = lambda load_id, hash_value: F.struct(
        F.lit(load_id).cast("bigint").alias("B_LOADID"), hash_value.alias("HASH_VALUE")
    )
    first = version(1, _content(F.when(status == "F", F.lit("O")).otherwise(status)))
    reloaded = (status == "F") & F.col("o_orderpriority").isin(*RELOADED)
    versions = F.when(reloaded, F.array(first, version(2, _content(status)))).otherwise(F.array(first))
    opened = table(spark, sf_dir, "orders").where(F.col("o_orderdate") < F.lit(OPENING_CUT).cast("timestamp_ntz"))
    return opened.select(F.col("o_orderkey").alias("ORDERS_ID"), F.inline(versions))


SQL_ORDER_HISTORY = f"""
SELECT 1::BIGINT AS B_LOADID, ORDERS_ID, HASH_VALUE FROM ({SQL_ORDER_OPENING})
UNION ALL
SELECT 2::BIGINT, ORDERS_ID, HASH_VALUE FROM ({SQL_ORDER_BATCH})
WHERE o_orderdate < TIMESTAMP '{OPENING_CUT}' AND o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')"""

SQL_LATEST = """
SELECT h.ORDERS_ID, h.B_LOADID, h.HASH_VALUE
FROM history h
JOIN (SELECT ORDERS_ID, max(B_LOADID) AS B_LOADID FROM history GROUP BY ORDERS_ID) g
  ON h.ORDERS_ID = g.ORDERS_ID AND h.B_LOADID = g.B_LOADID"""


# --- survey: attributes are returned lines, repairs all others -----------------------------------

def survey_asset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("AssetID"), F.col("c_name").alias("UPRN"))


# So much of the lines' files is joined in one task, whatever the session's number of shuffle partitions.
LINE_BYTES_PER_TASK = 8 * 1024**2
# Suppliers in files up to this size are sent to every executor, which spares moving all lines to them.
SUPPLIER_BYTES = 16 * 1024**2


def _survey_lines(spark: SparkSession, sf_dir: str, kept: Column) -> DataFrame:
    """The lines wanted, with order, supplier and part.

    What the lines are known by is put together as early as it can be, so that the later joins move less. The part comes
    last: the lines then lie by component, which is what the feeds group by, and are not moved again for that.
    """
    tasks = -(-folder_bytes(spark, f"{sf_dir}/lineitem.parquet") // LINE_BYTES_PER_TASK)
    large = tasks > int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = lambda df, key: df.repartition(tasks, key) if large else df
    lines = dealt(table(spark, sf_dir, "lineitem").where(kept), "l_orderkey")
    with_orders = lines.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_custkey", "o_orderpriority", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate",
        F.year("l_shipdate").alias("ship_year"), "l_quantity", "l_extendedprice",
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id"))
    supplier = table(spark, sf_dir, "supplier")
    if folder_bytes(spark, f"{sf_dir}/supplier.parquet") <= SUPPLIER_BYTES:
        supplier = F.broadcast(supplier)
    with_supplier = with_orders.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return dealt(with_supplier, "l_partkey").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))


def survey_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _survey_lines(spark, sf_dir, F.col("l_returnflag") == "R").select(
        F.col("o_custkey").alias("AssetID"),
        F.col("l_suppkey").alias("RepairElementID"),
        F.col("s_name").alias("RepairElement"),
        F.col("l_partkey").alias("ComponentID"),
        F.col("p_name").alias("Component"),
        F.col("l_linenumber").alias("AttributeID"),
        F.col("line_id").alias("SurveyAttributeID"),
        F.concat("p_brand", F.lit(" "), "l_linestatus").alias("Attribute"),
        F.col("l_shipdate").alias("InstallationDate"),
        F.col("o_orderpriority").alias("Surveyor"),
    )


def survey_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _survey_lines(spark, sf_dir, F.col("l_returnflag") != "R").select(
        F.col("o_custkey").alias("AssetID"),
        F.col("s_name").alias("RepairElement"),
        F.col("l_partkey").alias("ComponentID"),
        F.col("p_name").alias("Component"),
        F.col("l_linenumber").alias("RepairID"),
        F.col("line_id").alias("SurveyRepairID"),
        F.concat("p_type", F.lit(" "), "l_returnflag").alias("RepairDescription"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        F.col("ship_year").alias("YearDue"),
        money("l_extendedprice").alias("RepairCost"),
        F.col("o_orderpriority").alias("Surveyor"),
    )


def survey_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both halves, before the join to the assets."""
    return survey_findings(survey_attributes(spark, sf_dir), survey_repairs(spark, sf_dir))


SQL_SURVEY_CTES = """
lines AS (
  SELECT *, l_orderkey * 10 + l_linenumber AS line_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey),
survey AS (
  SELECT c_custkey AS AssetID, c_name AS UPRN, l_suppkey AS RepairElementID, s_name AS RepairElement,
         l_partkey AS ComponentID, p_name AS Component, l_linenumber AS AttributeID, line_id AS SurveyAttributeID,
         p_brand || ' ' || l_linestatus AS Attribute, l_shipdate AS InstallationDate, NULL::INTEGER AS RepairID,
         NULL::BIGINT AS SurveyRepairID, NULL::VARCHAR AS RepairDescription, NULL::INTEGER AS Quantity,
         NULL::INTEGER AS YearDue, NULL::DECIMAL(12,2) AS RepairCost, o_orderpriority AS Surveyor
  FROM customer JOIN lines ON c_custkey = o_custkey WHERE l_returnflag = 'R'
  UNION ALL
  SELECT c_custkey, c_name, NULL, s_name, l_partkey, p_name, NULL, NULL, NULL, NULL, l_linenumber, line_id,
         p_type || ' ' || l_returnflag, l_quantity::INTEGER, year(l_shipdate)::INTEGER,
         l_extendedprice::DECIMAL(12,2), o_orderpriority
  FROM customer JOIN lines ON c_custkey = o_custkey WHERE l_returnflag <> 'R')"""


# --- feeds: one feed per part, its type as company --------------------------------------------------

def feed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("SA_"), "p_brand").alias("target_table"),
        F.col("p_type").alias("company"),
        F.col("p_size").alias("hierarchy"),
        F.lit("server").alias("server"),
        F.when(F.col("p_brand") != "Brand#7", F.col("p_name")).alias("source_database"),
        F.lit("B_LOADID").alias("load_column"),
        F.concat(F.lit("SELECT * FROM part_"), F.col("p_partkey").cast("string")).alias("statement"),
        F.lit("ID").alias("primary_key"),
        F.lit(False).alias("delete_last"),
    )


SQL_FEED_ROWS = """
SELECT 'SA_' || p_brand AS target_table, p_type AS company, p_size AS hierarchy, 'server' AS server,
       CASE WHEN p_brand <> 'Brand#7' THEN p_name END AS source_database, 'B_LOADID' AS load_column,
       'SELECT * FROM part_' || p_partkey::VARCHAR AS statement, 'ID' AS primary_key, false AS delete_last
FROM part"""


# --- date texts ----------------------------------------------------------------------------------

def oracle_text(ts: str, year_digits: int = 4) -> Column:
    """A timestamp in the form DD-MON-YYYY HH:MI:SS, or with a two-digit year."""
    months = F.array(*map(F.lit, ["JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"]))
    iso = F.col(ts).cast("string")
    hour = F.lpad(((F.hour(ts) + 11) % 12 + 1).cast("string"), 2, "0")
    return F.concat(
        F.substring(iso, 9, 2), F.lit("-"), F.element_at(months, F.month(ts)), F.lit("-"),
        F.substring(iso, 5 - year_digits, year_digits), F.lit(" "), hour, F.substring(iso, 14, 6),
    )


def sql_oracle_text(ts: str, year: str = "%Y") -> str:
    return f"upper(strftime({ts}, '%d-%b-{year} %I:%M:%S'))"


def sql_morning(ts: str) -> str:
    """What a twelve-hour text of `ts` parses back to: the same time in the morning, to the second."""
    return (
        f"(date_trunc('day', {ts}) + to_hours((hour({ts}) % 12)::INTEGER) + to_minutes(minute({ts})::INTEGER) "
        f"+ to_seconds(second({ts})::INTEGER))"
    )



def residents_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One resident per order. By priority the start is a full text, one with a short year, junk, or NULL."""
    priority = F.col("o_orderpriority")
    start = (
        F.when(priority == "1-URGENT", oracle_text("o_orderdate"))
        .when(priority == "2-HIGH", oracle_text("o_orderdate", 2))
        .when(priority == "3-MEDIUM", F.concat(F.lit("from "), "o_orderstatus"))
        .when(priority == "5-LOW", F.lower(oracle_text("o_orderdate")))
    )
    end = F.when(F.col("o_orderstatus") == "F", oracle_text("o_orderdate"))
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_nationkey").alias("HOUSE_SIZE"),
        F.col("o_orderkey").alias("RESIDENTS_ID"),
        F.col("c_name").alias("HOUSE_REF"),
        F.col("o_custkey").alias("AGREEMENT_REF"),
        F.col("o_orderpriority").alias("AGREEMENT_DESC"),
        start.alias("START_OF_TERM"),
        end.alias("END_OF_TERM"),
        F.col("c_mktsegment").alias("CURRENT_OCCUPANT"),
        F.lit("GEN").alias("STOCK_GROUP"),
        (F.col("o_orderstatus") == "F").alias("OCCUPANCY_TERMINATED"),
        F.col("o_totalprice").alias("RENT_VALUE"),
        F.col("o_orderstatus").alias("OCCUPANCY_STATUS"),
        F.col("c_acctbal").alias("CURRENT_BALANCE"),
        F.lit(0).alias("SCH_VALUE"),
        F.lit("TENANT").alias("RESIDENT_TYPE"),
        F.lit("RG").alias("F_RENT_GRP_REF"),
        F.col("o_custkey").alias("F_UNITS"),
        F.col("c_mktsegment").alias("F_PROPERTY_TYPE"),
        F.lit("TT").alias("F_TENURE_TYPE"),
        F.lit("Residents").alias("B_CLASSNAME"),
        oracle_text("o_orderdate").alias("B_CREDATE"),
        F.lit("loader").alias("B_CREATOR"),
        F.lit(21).alias("F_SOURCE_SYSTEM"),
        F.lit(21).alias("F_DATA_OWNERSHIP"),
        F.md5(F.concat_ws("|", F.col("o_orderkey").cast("string"), "o_orderstatus")).alias("HASH_VALUE"),
    )


_SQL_RESIDENT = """
SELECT c_nationkey AS HOUSE_SIZE, o_orderkey AS RESIDENTS_ID, c_name AS HOUSE_REF, o_custkey AS AGREEMENT_REF,
       o_orderpriority AS AGREEMENT_DESC, {start} AS START_OF_TERM, {end} AS END_OF_TERM,
       c_mktsegment AS CURRENT_OCCUPANT, 'GEN' AS STOCK_GROUP, o_orderstatus = 'F' AS OCCUPANCY_TERMINATED,
       o_totalprice AS RENT_VALUE, o_orderstatus AS OCCUPANCY_STATUS, c_acctbal AS CURRENT_BALANCE, 0 AS SCH_VALUE,
       'TENANT' AS RESIDENT_TYPE, 'RG' AS F_RENT_GRP_REF, o_custkey AS F_UNITS, c_mktsegment AS F_PROPERTY_TYPE,
       'TT' AS F_TENURE_TYPE, 'Residents' AS B_CLASSNAME, {created} AS B_CREDATE, 'loader' AS B_CREATOR,
       21 AS F_SOURCE_SYSTEM, 21 AS F_DATA_OWNERSHIP, md5(o_orderkey::VARCHAR || '|' || o_orderstatus) AS HASH_VALUE
FROM orders JOIN customer ON o_custkey = c_custkey"""

SQL_RESIDENTS_VIEW = _SQL_RESIDENT.format(
    start=f"""CASE o_orderpriority WHEN '1-URGENT' THEN {sql_oracle_text("o_orderdate")}
         WHEN '2-HIGH' THEN {sql_oracle_text("o_orderdate", "%y")} WHEN '3-MEDIUM' THEN 'from ' || o_orderstatus
         WHEN '5-LOW' THEN lower({sql_oracle_text("o_orderdate")}) END""",
    end=f"CASE WHEN o_orderstatus = 'F' THEN {sql_oracle_text('o_orderdate')} END",
    created=sql_oracle_text("o_orderdate"),
)
SQL_RESIDENTS_FEED = _SQL_RESIDENT.format(
    start=f"CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW') THEN {sql_morning('o_orderdate')} END",
    end=f"CASE WHEN o_orderstatus = 'F' THEN {sql_morning('o_orderdate')} END",
    created=sql_morning("o_orderdate"),
)
