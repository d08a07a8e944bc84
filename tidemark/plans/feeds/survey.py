"""Three feeds from one union of survey attributes and survey repairs.

Each takes the assets and `survey_findings`, the union. A run that loads all three feeds reads the survey views
once when they are named to `plans.run.shared_views`.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import ExitStack, nullcontext

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.cleaning import concat_key
from tidemark.functions.dates import Instant, as_timestamp, validity_window
from tidemark.functions.hashing import row_hash, zone_free_views
from tidemark.operators.membership import rows_in
from tidemark.operators.numbering import global_row_number
from tidemark.operators.projection import not_in, union_all_padded
from tidemark.operators.registry import KeyRegistry
from tidemark.workspace import landed

# Fixed values of the three staging tables. The source system is a number in the first, text in the others.
KEY_LOOKUP = {"B_CLASSNAME": "AttributeKeyLookup", "F_SOURCE_SYSTEM": 41, "F_DATA_OWNERSHIP": 1}
KEY_VALUE = {"B_CLASSNAME": "PropAttributeKeyValue", "F_SOURCE_SYSTEM": "41", "F_DATA_OWNERSHIP": "1"}
ATTRIBUTE_TYPE = {
    "TYPE_CATEGORY": "COMPONENTS",
    "PROPERTY_LEVEL": "Units",
    "B_CLASSNAME": "PropAttributeType",
    "F_SOURCE_SYSTEM": "41",
    "F_DATA_OWNERSHIP": "1",
}
TYPE_PREFIX = "TP_"
EXCLUDED_ELEMENTS = ("HHSRS", "Portfolio Investment Opportunity ")

ATTRIBUTE_COLUMNS = [
    "AssetID", "RepairElementID", "RepairElement", "ComponentID", "Component", "AttributeID",
    "SurveyAttributeID", "Attribute", "InstallationDate", "Surveyor",
]
REPAIR_COLUMNS = [
    "AssetID", "RepairElement", "ComponentID", "Component", "RepairID", "SurveyRepairID",
    "RepairDescription", "Quantity", "YearDue", "RepairCost", "Surveyor",
]


@zone_free_views
def survey_findings(attributes: DataFrame, repairs: DataFrame) -> DataFrame:
    """Attribute rows and repair rows one below the other, each padded with NULL."""
    return union_all_padded(attributes.select(*ATTRIBUTE_COLUMNS), repairs.select(*REPAIR_COLUMNS))


def survey_rows(asset: DataFrame, findings: DataFrame) -> DataFrame:
    """The findings of known assets, with the UPRN of the asset.

    Both halves belong to the same assets, so their union is joined once rather than each half.
    """
    return asset.select("AssetID", "UPRN").join(findings, "AssetID")


def _of_known_assets(asset: DataFrame, findings: DataFrame) -> DataFrame:
    return rows_in(findings, asset, {"AssetID": "AssetID"})


def _constants(values: dict) -> list[Column]:
    return [F.lit(value).alias(name) for name, value in values.items()]


def _validity(as_of: Column) -> list[Column]:
    start, end = validity_window(as_of)
    return [start.alias("VALID_FROM"), end.alias("VALID_TO")]


@zone_free_views
def key_lookup_feed(asset: DataFrame, findings: DataFrame, *, as_of: Instant, creator: str) -> DataFrame:
    """The distinct components."""
    as_of = as_timestamp(as_of)
    # Few components occur per asset, so they are made distinct on the map side before assets are looked up.
    found = findings.select("AssetID", "ComponentID", "Component").distinct()
    components = _of_known_assets(asset, found).select("ComponentID", "Component").distinct()
    return components.select(
        F.col("ComponentID").alias("ATTRIBUTE_KEY_LOOKUP_ID"),
        F.col("Component").alias("KEY_NAME"),
        row_hash("ComponentID", "Component").alias("HASH_VALUE"),
        *_constants(KEY_LOOKUP),
        as_of.alias("B_CREDATE"),
        F.lit(creator).alias("B_CREATOR"),
        *_validity(as_of),
    )


@zone_free_views
def attribute_type_feed(asset: DataFrame, findings: DataFrame, *, as_of: Instant, creator: str) -> DataFrame:
    """The distinct elements that have an id, which repair rows never have."""
    as_of = as_timestamp(as_of)
    identified = findings.where(F.col("RepairElementID").isNotNull()).select("AssetID", "RepairElementID", "RepairElement").distinct()
    elements = _of_known_assets(asset, identified).select("RepairElementID", "RepairElement").distinct()
    return elements.select(
        concat_key(TYPE_PREFIX, F.col("RepairElementID")).alias("PROP_ATTRIBUTE_TYPE_ID"),
        F.col("RepairElement").alias("TYPE_NAME"),
        row_hash("RepairElementID", "RepairElement").alias("HASH_VALUE"),
        *_constants(ATTRIBUTE_TYPE),
        as_of.alias("B_CREDATE"),
        F.lit(creator).alias("B_CREATOR"),
        *_validity(as_of),
    )


# What names a row of the key-value feed at the source.
NATURAL_KEY = ["ComponentID", "AssetID", "UPRN", "RepairElement", "Component"]


@zone_free_views
def key_value_registry(path: str, asset: DataFrame, findings: DataFrame) -> KeyRegistry:
    """A registry for the feed's natural keys, with the types they have in the views."""
    return KeyRegistry.of(path, asset.select("AssetID", "UPRN").join(findings, "AssetID").select(*NATURAL_KEY))


GROUP = ["AssetID", "ComponentID", "RepairElement", "Component"]


@zone_free_views
def finding_maxima(findings: DataFrame, excluded: Sequence[str] = EXCLUDED_ELEMENTS) -> DataFrame:
    """The maxima of the findings of each asset, element and component: what the key-value feed reduces its findings to."""
    return findings.where(not_in(F.col("RepairElement"), excluded)).groupBy(*GROUP).agg(
        F.max("RepairElementID").alias("RepairElementID"),
        F.max("Attribute").alias("Attribute"),
        F.max("InstallationDate").alias("InstallationDate"),
        F.max("RepairDescription").alias("Replacement"),
        F.max("RepairCost").alias("ReplacementCost"),
        F.max("Quantity").alias("Quantity"),
        F.max("YearDue").alias("YearDue"),
        F.max(F.coalesce("SurveyAttributeID", "SurveyRepairID")).alias("SurveyAttributeID"),
        F.max("Surveyor").alias("Surveyor"),
    )


@zone_free_views
def key_value_feed(
    asset: DataFrame,
    findings: DataFrame,
    *,
    as_of: Instant,
    creator: str,
    excluded: Sequence[str] = EXCLUDED_ELEMENTS,
    numbered: bool = True,
    registry: KeyRegistry | None = None,
    maxima: DataFrame | None = None,
) -> DataFrame:
    """One row per asset, element and component, with the maxima of its attribute and repair rows.

    A group of repairs alone has no element id, hence no type key. Attribute and repair ids share one
    column, so the larger of the two ranges wins.

    The key is a row number, which shifts whenever a row is added upstream: the load then compares a
    row with another row's history and may append it again. `numbered=False` gives a stable key
    instead, the hash of the group's natural key, and a `registry` of natural keys numbers that stay: groups new to it get
    the next ones when this is called, in the order of the row numbers.

    The maxima are taken before the join to the assets, which changes nothing, as a repeated row does
    not change a maximum. An asset with very many findings is thus reduced on the map side and spread
    by element and component, and the join moves one row per group. Where several runs take the same findings, their
    `finding_maxima` can be written once and given to each. For row numbers the maxima and then the groups are written, each until
    the next is, so that no two of the shuffles behind them lie on disk at a time.
    """
    as_of = as_timestamp(as_of)
    reduced = finding_maxima(findings, excluded) if maxima is None else maxima
    groups_of = lambda rows: asset.select("AssetID", "UPRN").distinct().join(rows, "AssetID")
    natural = NATURAL_KEY
    key = "PROP_ATTRIBUTE_KEY_VALUE_"
    if registry is not None:
        keyed = registry.assigned(groups_of(reduced), key, ["UPRN", "SurveyAttributeID"])
    elif numbered:
        with ExitStack() as held:
            with landed(reduced, "maxima") if maxima is None else nullcontext(maxima) as rows:
                groups = held.enter_context(landed(groups_of(rows), "groups"))
            keyed = global_row_number(groups, ["UPRN", "SurveyAttributeID"], key, tie_break=natural, distinct_rows=True)
    else:
        keyed = groups_of(reduced).withColumn(key, row_hash(*natural))
    return keyed.select(
        key,
        F.col("UPRN").alias("F_PROPERTY_ATTRIBUTES"),
        F.col("Attribute").alias("ATTRIBUTE_VALUE"),
        F.col("ComponentID").alias("F_ATTRIBUTE_KEY_LOOKUP"),
        F.col("InstallationDate").alias("ATTRIBUTE_DATE"),
        F.col("Quantity").alias("QUANTITY"),
        concat_key(TYPE_PREFIX, F.col("RepairElementID")).alias("F_PROP_ATTRIBUTE_TYPE"),
        F.col("Replacement").alias("REPLACEMENT"),
        F.col("ReplacementCost").alias("REPLACEMENT_COST"),
        F.col("Surveyor").alias("SURVEYOR"),
        F.col("YearDue").alias("DUE_DATE"),
        row_hash(
            "SurveyAttributeID", "UPRN", "Attribute", "ComponentID", "InstallationDate", "Quantity",
            "RepairElementID", "Replacement", "ReplacementCost", "Surveyor", "YearDue",
        ).alias("HASH_VALUE"),
        *_constants(KEY_VALUE),
        as_of.alias("B_CREDATE"),
        F.lit(creator).alias("B_CREATOR"),
    )
