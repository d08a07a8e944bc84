"""The feeds, their source views stood in for by the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.cleaning import pad_left
from tidemark.operators.projection import stamp_load_id
from tidemark.plans.feeds import (
    attribute_type_feed,
    blocks_feed,
    communications_feed,
    finding_maxima,
    inspections_feed,
    key_lookup_feed,
    key_value_feed,
    key_value_registry,
    residents_feed,
    schemes_feed,
    units_feed,
)
from tidemark.plans.feeds.communications import current_parties
from tidemark.plans.feeds.residents import residents_bad_dates
from tidemark.plans.rejects import REJECT_SCHEMA, REJECTS
from tidemark.plans.run import run_feeds
from tidemark.queries.frames import (
    AS_OF,
    SQL_AS_OF,
    SQL_RESIDENTS_FEED,
    SQL_SURVEY_CTES,
    residents_view,
    survey_asset,
    survey_union,
)
from tidemark.queries.registry import query, table
from tidemark.sinks import CommittedTarget
from tidemark.specs import FeedSpec
from tidemark.workspace import materialise, new_path

CREATOR = "Survey Integration"


def _sql_hash(*columns: str) -> str:
    """The default row hash over the columns."""
    return "sha256(" + " || chr(31) || ".join(f"coalesce(({c})::VARCHAR, chr(30))" for c in columns) + ")"


def _survey(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return survey_asset(spark, sf_dir), survey_union(spark, sf_dir)


SQL_STAMPS = f"""{SQL_AS_OF} AS B_CREDATE, '{CREATOR}' AS B_CREATOR"""
SQL_VALIDITY = f"""{SQL_AS_OF} - INTERVAL 1 DAY AS VALID_FROM, {SQL_AS_OF} + INTERVAL 100 MONTH AS VALID_TO"""


@query(f"""WITH {SQL_SURVEY_CTES}
SELECT DISTINCT ComponentID AS ATTRIBUTE_KEY_LOOKUP_ID, Component AS KEY_NAME,
       {_sql_hash("ComponentID", "Component")} AS HASH_VALUE, 'AttributeKeyLookup' AS B_CLASSNAME,
       41 AS F_SOURCE_SYSTEM, 1 AS F_DATA_OWNERSHIP, {SQL_STAMPS}, {SQL_VALIDITY}
FROM survey""")
def q_feed_key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_lookup_feed(*_survey(spark, sf_dir), as_of=AS_OF, creator=CREATOR)


EXCLUDED = ("Supplier#000000001", "Supplier#000000002 ")


def _sql_key_value(key: str) -> str:
    return f"""WITH {SQL_SURVEY_CTES},
groups AS (
  SELECT ComponentID, AssetID, UPRN, RepairElement, Component, max(RepairElementID) AS RepairElementID,
         max(Attribute) AS Attribute, max(InstallationDate) AS InstallationDate,
         max(RepairDescription) AS Replacement, max(RepairCost) AS ReplacementCost, max(Quantity) AS Quantity,
         max(YearDue) AS YearDue, max(coalesce(SurveyAttributeID, SurveyRepairID)) AS SurveyAttributeID,
         max(Surveyor) AS Surveyor
  FROM survey WHERE rtrim(RepairElement) NOT IN ('Supplier#000000001', 'Supplier#000000002')
  GROUP BY ComponentID, AssetID, UPRN, RepairElement, Component)
SELECT {key} AS PROP_ATTRIBUTE_KEY_VALUE_, UPRN AS F_PROPERTY_ATTRIBUTES, Attribute AS ATTRIBUTE_VALUE,
       ComponentID AS F_ATTRIBUTE_KEY_LOOKUP, InstallationDate AS ATTRIBUTE_DATE, Quantity AS QUANTITY,
       'TP_' || RepairElementID::VARCHAR AS F_PROP_ATTRIBUTE_TYPE, Replacement AS REPLACEMENT,
       ReplacementCost AS REPLACEMENT_COST, Surveyor AS SURVEYOR, YearDue AS DUE_DATE,
       {_sql_hash("SurveyAttributeID", "UPRN", "Attribute", "ComponentID", "InstallationDate", "Quantity",
                  "RepairElementID", "Replacement", "ReplacementCost", "Surveyor", "YearDue")} AS HASH_VALUE,
       'PropAttributeKeyValue' AS B_CLASSNAME, '41' AS F_SOURCE_SYSTEM, '1' AS F_DATA_OWNERSHIP, {SQL_STAMPS}
FROM groups"""


@query(_sql_key_value(
    "row_number() OVER (ORDER BY UPRN NULLS FIRST, SurveyAttributeID NULLS FIRST, ComponentID NULLS FIRST, "
    "AssetID NULLS FIRST, RepairElement NULLS FIRST, Component NULLS FIRST)"
))
def q_feed_key_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_value_feed(*_survey(spark, sf_dir), as_of=AS_OF, creator=CREATOR, excluded=EXCLUDED)


@query(_sql_key_value(_sql_hash("ComponentID", "AssetID", "UPRN", "RepairElement", "Component")))
def q_feed_key_value_natural(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_value_feed(
        *_survey(spark, sf_dir), as_of=AS_OF, creator=CREATOR, excluded=EXCLUDED, numbered=False
    )


@query(_sql_key_value(
    "row_number() OVER (ORDER BY UPRN IS NULL OR UPRN > 'Customer#000000400', UPRN NULLS FIRST, SurveyAttributeID NULLS FIRST, "
    "ComponentID NULLS FIRST, AssetID NULLS FIRST, RepairElement NULLS FIRST, Component NULLS FIRST)"
))
def q_feed_key_value_registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys from a registry that a first run over some of the assets has begun."""
    asset, findings = _survey(spark, sf_dir)
    registry = key_value_registry(new_path(spark, "keys"), asset, findings)
    # Both runs take the same findings; written, the few assets of the first are seen to be few.
    maxima = materialise(finding_maxima(findings, EXCLUDED), "maxima")
    run = lambda of: key_value_feed(
        of, findings, as_of=AS_OF, creator=CREATOR, excluded=EXCLUDED, registry=registry, maxima=maxima)
    run(materialise(asset.where("UPRN <= 'Customer#000000400'"), "assets"))
    return run(asset)


@query(f"""WITH {SQL_SURVEY_CTES}
SELECT DISTINCT 'TP_' || RepairElementID::VARCHAR AS PROP_ATTRIBUTE_TYPE_ID, RepairElement AS TYPE_NAME,
       {_sql_hash("RepairElementID", "RepairElement")} AS HASH_VALUE, 'COMPONENTS' AS TYPE_CATEGORY,
       'Units' AS PROPERTY_LEVEL, 'PropAttributeType' AS B_CLASSNAME, '41' AS F_SOURCE_SYSTEM,
       '1' AS F_DATA_OWNERSHIP, {SQL_STAMPS}, {SQL_VALIDITY}
FROM survey WHERE RepairElementID IS NOT NULL""")
def q_feed_attribute_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribute_type_feed(*_survey(spark, sf_dir), as_of=AS_OF, creator=CREATOR)


@query(SQL_RESIDENTS_FEED)
def q_feed_residents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residents_feed(residents_view(spark, sf_dir))


@query("""
SELECT count(*) FILTER (WHERE o_orderpriority = '3-MEDIUM') AS START_OF_TERM, 0::BIGINT AS END_OF_TERM,
       0::BIGINT AS B_CREDATE FROM orders""")
def q_bad_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residents_bad_dates(residents_view(spark, sf_dir))


@query("""
SELECT 7::BIGINT AS B_LOADID, 'SA_RESIDENTS' AS TARGET_TABLE, o_orderkey::VARCHAR AS ROW_KEY, 'START_OF_TERM' AS COLUMN_NAME,
       'from ' || o_orderstatus AS TEXT, 'not a date' AS REASON
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority = '3-MEDIUM'""")
def q_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reject table after a load of the residents."""
    return _residents_run(spark, sf_dir)[1].read(spark)


@query("""
SELECT 'SA_RESIDENTS' AS target_table, count(*) AS retrieved, count(*) FILTER (WHERE o_orderpriority <> '3-MEDIUM') AS inserted,
       count(*) FILTER (WHERE o_orderpriority = '3-MEDIUM') AS rejected, 'loaded' AS status
FROM orders JOIN customer ON o_custkey = c_custkey""")
def q_load_audit_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of that load."""
    return _residents_run(spark, sf_dir)[0].select("target_table", "retrieved", "inserted", "rejected", "status")


def _residents_run(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, CommittedTarget]:
    feed = residents_feed(residents_view(spark, sf_dir), rejects=True)
    target = CommittedTarget(new_path(spark, "residents"), stamp_load_id(feed.drop(REJECTS), 0).schema)
    rejects = CommittedTarget(new_path(spark, "rejects"), REJECT_SCHEMA)
    audit = run_feeds(
        spark, [FeedSpec("SA_RESIDENTS", "first", 1, "RESIDENTS_ID")], read=lambda spec: feed, target=lambda spec: target,
        load_id=lambda spec: 7, rejects=rejects)
    return audit, rejects


# --- units: one per order line, in the building of its supplier ----------------------------------

@query(f"""
WITH units AS (
  SELECT l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR || '-' || l_partkey::VARCHAR AS code, p_name AS name,
         CASE WHEN l_returnflag <> 'N' THEN p_brand || ', ' || p_type END AS address, p_brand AS number,
         nullif(l_returnflag, 'A') AS line1, l_linestatus AS line2, p_type AS street, p_size::VARCHAR AS postcode,
         CASE WHEN l_linestatus = 'O' THEN l_linenumber END AS bedrooms,
         CASE p_type WHEN 'MEDIUM' THEN 'Available' WHEN 'STANDARD' THEN 'Booked' WHEN 'LARGE' THEN 'Occupied'
                     WHEN 'PROMO' THEN 'On Hold' WHEN 'SMALL' THEN 'Sold' END AS status,
         CASE p_size WHEN 30 THEN '2/3-Mez' WHEN 31 THEN 'G' WHEN 32 THEN 'Ground' ELSE p_size::VARCHAR END AS floor,
         CASE WHEN l_tax > 0.04 THEN 'taxed' END AS comments,
         'Supplier#' || lpad(l_suppkey::VARCHAR, greatest(9, length(l_suppkey::VARCHAR))::INTEGER, '0') AS building
  FROM lineitem JOIN part ON l_partkey = p_partkey),
joined AS (
  SELECT u.*, 'B' || s_suppkey::VARCHAR AS building_ref
  FROM units u JOIN supplier ON building = s_name JOIN nation ON s_nationkey = n_nationkey)
SELECT 'Units' AS B_CLASSNAME, building_ref AS F_BLOCKS, code AS UNITS_ID, name AS PROPERTY_NAME,
       address AS SHORT_ADDRESS, number AS GEOADDRESS1, line1 AS GEOADDRESS2, line2 AS GEOADDRESS3,
       street AS GEOTOWN, postcode AS GEOPOSTCODE, coalesce(bedrooms, 0)::INTEGER AS NO_OF_BEDROOMS,
       CASE WHEN status IN ('Available', 'Booked') THEN '022' WHEN status = 'Occupied' THEN '004'
            WHEN status = 'On Hold' THEN '024' ELSE '000' END AS OCCUPANCY_STATUS,
       CASE floor WHEN '1' THEN '004' WHEN '2' THEN '005' WHEN '3' THEN '006' WHEN '4' THEN '007' WHEN '5' THEN '009'
            WHEN '6' THEN '010' WHEN '7' THEN '011' WHEN '8' THEN '012' WHEN '9' THEN '013' WHEN '10' THEN '014'
            WHEN '11' THEN '015' WHEN '12' THEN '016' WHEN '13' THEN '017' WHEN '14' THEN '018'
            WHEN '2/3-Mez' THEN '030' WHEN 'G' THEN '002' WHEN 'Ground' THEN '002' ELSE '000' END AS FLOOR_LEVEL,
       comments AS ANY_OTHER_INFORMATION, '3' AS F_SOURCE_SYSTEM, '3' AS F_DATA_OWNERSHIP,
       sha1(building_ref || code || name || coalesce(address, 'NA') || number || coalesce(line1, 'NA') || line2
            || street || postcode || coalesce(comments, 'NA')) AS HASH_VALUE
FROM joined""")
def q_feed_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lambda c: F.col(c).cast("string")
    size, kind, flag = F.col("p_size"), F.col("p_type"), F.col("l_returnflag")
    property_index = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    ).select(
        F.concat_ws("-", text("l_orderkey"), text("l_linenumber"), text("l_partkey")).alias("Property Code"),
        F.col("p_name").alias("Property Name"),
        F.when(flag != "N", F.concat("p_brand", F.lit(", "), "p_type")).alias("Full Address"),
        F.col("p_brand").alias("Property Number"),
        F.when(flag != "A", flag).alias("Address Line1"),
        F.col("l_linestatus").alias("Address Line2"),
        kind.alias("Street"),
        text("p_size").alias("Postcode"),
        F.when(F.col("l_linestatus") == "O", F.col("l_linenumber")).alias("Bedrooms"),
        F.when(kind == "MEDIUM", "Available").when(kind == "STANDARD", "Booked").when(kind == "LARGE", "Occupied")
        .when(kind == "PROMO", "On Hold").when(kind == "SMALL", "Sold").alias("Property Status"),
        F.when(size == 30, "2/3-Mez").when(size == 31, "G").when(size == 32, "Ground").otherwise(text("p_size"))
        .alias("Floor"),
        F.when(F.col("l_tax") > 0.04, "taxed").alias("Comments"),
        F.concat(F.lit("Supplier#"), pad_left(text("l_suppkey"), 9, "0")).alias("Building"),
    )
    return units_feed(property_index, _supplier_buildings(spark, sf_dir), _nation_areas(spark, sf_dir))


def _supplier_buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("B"), F.col("s_suppkey").cast("string")).alias("buildingRef_"),
        F.col("s_name").alias("name_"),
        F.col("s_nationkey").alias("area_"),
    )


def _nation_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("ID"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("code_"),
        F.col("n_name").alias("name_"),
    )


@query(f"""
SELECT 'Blocks' AS B_CLASSNAME, 'C' || c_custkey::VARCHAR AS BLOCKS_ID, c_name AS BLOCK_NAME,
       'N' || n_nationkey::VARCHAR AS F_SCHEMES, s_name AS GEOADDRESS1, nullif(s_nationkey, 3)::VARCHAR AS GEOADDRESS2,
       CASE WHEN s_suppkey IS NOT NULL THEN 'Town' END AS GEOTOWN, s_suppkey::VARCHAR AS GEOPOSTCODE,
       '3' AS F_SOURCE_SYSTEM, '3' AS F_DATA_OWNERSHIP,
       {_sql_hash("'C' || c_custkey::VARCHAR", "c_name", "'N' || n_nationkey::VARCHAR", "s_name",
                  "nullif(s_nationkey, 3)", "CASE WHEN s_suppkey IS NOT NULL THEN 'Town' END", "s_suppkey")}
         AS HASH_VALUE
FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN supplier ON c_custkey = s_suppkey""")
def q_feed_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    building = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("buildingRef_"),
        F.col("c_name").alias("name_"),
        F.col("c_nationkey").alias("area_"),
        F.col("c_custkey").alias("address_"),
    )
    address = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("ID"),
        F.col("s_name").alias("line1_"),
        F.when(F.col("s_nationkey") != 3, F.col("s_nationkey").cast("string")).alias("line2_"),
        F.lit("Town").alias("line3_"),
        F.col("s_suppkey").cast("string").alias("postcode_"),
    )
    return blocks_feed(building, _nation_areas(spark, sf_dir), address)


@query(f"""
SELECT 'Schemes' AS B_CLASSNAME, 'S' || s_suppkey::VARCHAR AS SCHEMES_ID, s_name AS SCHEME_NAME,
       'EST_001' AS F_ESTATES, '3' AS F_SOURCE_SYSTEM, '3' AS F_DATA_OWNERSHIP,
       {_sql_hash("'S' || s_suppkey::VARCHAR", "s_name")} AS HASH_VALUE
FROM supplier""")
def q_feed_schemes(spark: SparkSession, sf_dir: str) -> DataFrame:
    area = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("code_"), F.col("s_name").alias("name_")
    )
    return schemes_feed(area, estate="EST_001")


# --- inspections: one per order, texts padded ----------------------------------------------------

_SQL_INSPECTION_VIEW = """
SELECT o_custkey::VARCHAR || '    ' AS prop_ref, o_orderkey::VARCHAR || '  ' AS resident_inspector,
       CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority || '   ' END AS inspection_priority,
       CASE o_orderstatus WHEN 'F' THEN 'Just Ask    ' WHEN 'O' THEN 'Another' END AS grounds_contractor,
       CASE o_orderstatus WHEN 'F' THEN '   ' WHEN 'O' THEN 'Team O  ' END AS grounds_team,
       CASE o_orderstatus WHEN 'P' THEN 'Cleanscapes ' WHEN 'O' THEN 'Another' END AS cleaning_contractor,
       CASE o_orderstatus WHEN 'P' THEN '' WHEN 'O' THEN 'Team C' END AS cleaning_team,
       month(o_orderdate)::VARCHAR || ' ' AS staff_grounds_cnt,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE::VARCHAR || '  ' END AS staff_grounds_last_date,
       day(o_orderdate)::VARCHAR AS staff_cleaning_cnt,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE::VARCHAR ELSE '   ' END AS staff_cleaning_last_date,
       o_orderstatus || '  ' AS grounds_status, 'soon' AS grounds_due, o_orderstatus AS cleaning_status,
       o_orderdate::DATE::VARCHAR AS cleaning_due, NULL::VARCHAR AS resident_grounds_cnt,
       NULL::VARCHAR AS resident_grounds_last_date, '0' AS resident_cleaning_cnt,
       o_orderdate::DATE::VARCHAR AS resident_cleaning_last_date
FROM orders"""

_INSPECTION_COLUMNS = [
    "prop_ref", "resident_inspector", "inspection_priority", "grounds_contractor", "grounds_team",
    "cleaning_contractor", "cleaning_team", "staff_grounds_cnt", "staff_grounds_last_date", "staff_cleaning_cnt",
    "staff_cleaning_last_date", "grounds_status", "grounds_due", "cleaning_status", "cleaning_due",
    "resident_grounds_cnt", "resident_grounds_last_date", "resident_cleaning_cnt", "resident_cleaning_last_date",
]
_ORDER_OF_INSPECTIONS = ", ".join(f"{c} NULLS FIRST" for c in _INSPECTION_COLUMNS)


def _sql_text(column: str) -> str:
    return f"coalesce(rtrim({column}), '')"


def _sql_date(column: str) -> str:
    return (
        f"CASE WHEN coalesce(rtrim({column}), '') = '' THEN DATE '1900-01-01' "
        f"ELSE coalesce(try_cast(rtrim({column}) AS DATE), try_strptime(rtrim({column}), '%b %d %Y')::DATE) END"
    )


@query(f"""
WITH view AS ({_SQL_INSPECTION_VIEW})
SELECT row_number() OVER (ORDER BY {_ORDER_OF_INSPECTIONS}) AS ESTATE_INSP_AND_CLEANING_,
       {_sql_text("prop_ref")} AS FD_SCHEMES, {_sql_text("resident_inspector")} AS RESIDENT_INSPECTOR,
       {_sql_text("inspection_priority")} AS PRIORITY,
       CASE WHEN rtrim(grounds_contractor) = 'Just Ask' THEN '1' ELSE '21' END AS FD_CONTRACTOR_INSP,
       {_sql_text("grounds_team")} AS GROUNDS_TEAM,
       CASE WHEN rtrim(cleaning_contractor) = 'Cleanscapes' THEN '4' ELSE '21' END AS FD_CONTRACTOR_CLEANING,
       {_sql_text("cleaning_team")} AS CLEANING_TEAM, {_sql_text("staff_grounds_cnt")} AS STAFF_GROUNDS_COUNT,
       {_sql_date("staff_grounds_last_date")} AS STAFF_GROUNDS_LASTDATE,
       {_sql_text("staff_cleaning_cnt")} AS STAFF_CLEANING_COUNT,
       {_sql_date("staff_cleaning_last_date")} AS LAST_CLEANING_DATE, {_sql_text("grounds_status")} AS GROUND_STATUS,
       {_sql_date("grounds_due")} AS GROUNDS_DUE, {_sql_text("cleaning_status")} AS CLEANING_STATUS,
       {_sql_date("cleaning_due")} AS CLEANING_DUE, {_sql_text("resident_grounds_cnt")} AS RESIDENTS_COUNT,
       {_sql_date("resident_grounds_last_date")} AS RESIDENT_GROUNDS_LAST_DAT,
       {_sql_text("resident_cleaning_cnt")} AS RESIDENTS_CLEANING_COUNT,
       {_sql_date("resident_cleaning_last_date")} AS RESIDENT_CLEAN_LAST_DATE,
       'EstateInspAndCleaning' AS B_CLASSNAME, {_sql_hash(*_INSPECTION_COLUMNS)} AS HASH_VALUE, {SQL_STAMPS}
FROM view""")
def q_feed_inspections(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, date = F.col("o_orderstatus"), F.col("o_orderdate").cast("date").cast("string")
    pad = lambda c, blanks: F.concat(F.col(c).cast("string"), F.lit(" " * blanks))
    view = table(spark, sf_dir, "orders").select(
        pad("o_custkey", 4).alias("prop_ref"),
        pad("o_orderkey", 2).alias("resident_inspector"),
        F.when(F.col("o_orderpriority") != "5-LOW", pad("o_orderpriority", 3)).alias("inspection_priority"),
        F.when(status == "F", "Just Ask    ").when(status == "O", "Another").alias("grounds_contractor"),
        F.when(status == "F", "   ").when(status == "O", "Team O  ").alias("grounds_team"),
        F.when(status == "P", "Cleanscapes ").when(status == "O", "Another").alias("cleaning_contractor"),
        F.when(status == "P", "").when(status == "O", "Team C").alias("cleaning_team"),
        F.concat(F.month("o_orderdate").cast("string"), F.lit(" ")).alias("staff_grounds_cnt"),
        F.when(status != "P", F.concat(date, F.lit("  "))).alias("staff_grounds_last_date"),
        F.day("o_orderdate").cast("string").alias("staff_cleaning_cnt"),
        F.when(status != "P", date).otherwise("   ").alias("staff_cleaning_last_date"),
        F.concat(status, F.lit("  ")).alias("grounds_status"),
        F.lit("soon").alias("grounds_due"),
        status.alias("cleaning_status"),
        date.alias("cleaning_due"),
        F.lit(None).cast("string").alias("resident_grounds_cnt"),
        F.lit(None).cast("string").alias("resident_grounds_last_date"),
        F.lit("0").alias("resident_cleaning_cnt"),
        date.alias("resident_cleaning_last_date"),
    )
    return inspections_feed(view, as_of=AS_OF, creator=CREATOR)


# --- communications: customers with a current order, as lease, or a current line, as tenancy ------

_SQL_CHANNEL = """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'ZCM-MT1' WHEN 'BUILDING' THEN 'ZCM-UE1'
  WHEN 'FURNITURE' THEN 'ZCM-L' ELSE 'ZCM-O' END"""
_SQL_PRECEDENCE = "CASE WHEN c_nationkey = 1 THEN '001' WHEN c_nationkey > 1 THEN '002' ELSE '000' END"


@query(f"""
WITH leases AS (
  SELECT o_orderkey AS lease, o_orderdate AS start_date,
         CASE WHEN NOT (o_orderstatus = 'O' AND o_orderpriority = '1-URGENT') THEN o_orderdate + INTERVAL 30 DAY END
           AS end_date
  FROM orders),
contacts AS (
  SELECT nullif(c_mktsegment, 'MACHINERY') AS VALUE, c_name AS COMMUNICATION_NAME,
         {_SQL_PRECEDENCE} AS DEFAULT_COMMUNICATION, c_custkey AS F_PERSON, {_SQL_CHANNEL} AS F_COMMUNICATION_TYPE,
         NULL::VARCHAR AS OTHER_INFO, c_custkey * 10 AS COMMUNICATION_ID
  FROM customer p
  WHERE EXISTS (SELECT 1 FROM orders JOIN leases ON lease = o_orderkey
                WHERE {SQL_AS_OF} BETWEEN start_date AND coalesce(end_date, {SQL_AS_OF}) AND o_custkey = p.c_custkey)
     OR EXISTS (SELECT 1 FROM orders JOIN lineitem ON l_orderkey = o_orderkey
                WHERE o_custkey = p.c_custkey
                  AND {SQL_AS_OF} BETWEEN l_shipdate AND l_shipdate + INTERVAL 60 DAY))
SELECT *, 'Communication' AS B_CLASSNAME, '2001-03-15 02:05:06' AS B_CREDATE, '{CREATOR}' AS B_CREATOR,
       21 AS F_DATA_OWNERSHIP, 21 AS F_SOURCE_SYSTEM,
       sha1(concat(VALUE, COMMUNICATION_NAME, DEFAULT_COMMUNICATION, F_PERSON::VARCHAR, F_COMMUNICATION_TYPE,
                   OTHER_INFO, COMMUNICATION_ID::VARCHAR)) AS HASH_VALUE
FROM contacts""")
def q_feed_communications(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, orders, lineitem = (table(spark, sf_dir, t) for t in ("customer", "orders", "lineitem"))
    segment, custkey = F.col("c_mktsegment"), F.col("c_custkey")
    code = (
        F.when(segment == "AUTOMOBILE", "TELEPHONE").when(segment == "BUILDING", "EMAIL")
        .when(segment == "FURNITURE", "LETTER").when(segment == "HOUSEHOLD", "FAX, EBILL,FACEBOOK,TWITTER")
        .otherwise("PIGEON")
    )
    contact_details = customer.select(
        (custkey * 10).alias("cde_refno"),
        custkey.alias("cde_par_refno"),
        F.when(segment != "MACHINERY", segment).alias("cde_contact_value"),
        F.col("c_name").alias("cde_contact_name"),
        F.col("c_nationkey").cast("string").alias("cde_precedence"),
        code.alias("cde_frv_cme_code"),
    )
    open_ended = (F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "1-URGENT")
    current = current_parties(
        orders.select(F.col("o_orderkey").alias("lpt_las_lea_pro_refno"), F.col("o_custkey").alias("lpt_par_refno")),
        orders.select(
            F.col("o_orderkey").alias("las_lea_pro_refno"),
            F.col("o_orderdate").alias("las_start_date"),
            F.when(~open_ended, F.col("o_orderdate") + F.expr("INTERVAL 30 DAY")).alias("las_end_date"),
        ),
        orders.select(F.col("o_custkey").alias("tin_hop_refno"), F.col("o_orderkey").alias("tin_tcy_refno")),
        customer.select(custkey.alias("hop_refno"), custkey.alias("hop_par_refno")),
        lineitem.select(
            F.col("l_orderkey").alias("tcy_refno"),
            F.col("l_shipdate").alias("tcy_act_start_date"),
            (F.col("l_shipdate") + F.expr("INTERVAL 60 DAY")).alias("tcy_act_end_date"),
        ),
        as_of=AS_OF,
    )
    parties = customer.select(custkey.alias("par_refno"))
    return communications_feed(contact_details, parties, current, as_of=AS_OF, creator=CREATOR)
