"""Units, blocks and schemes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.cleaning import isnull_default
from tidemark.functions.decoding import decode, decode_like
from tidemark.functions.hashing import row_hash, sha1_null_marked, zone_free_views

# Occupancy and floor codes, and the constants of the staging tables.
OCCUPANCY_CODES = {"Available": "022", "Booked": "022", "Occupied": "004", "On Hold": "024"}
FLOOR_CODES = {
    "1": "004", "2": "005", "3": "006", "4": "007", "5": "009", "6": "010", "7": "011", "8": "012",
    "9": "013", "10": "014", "11": "015", "12": "016", "13": "017", "14": "018",
    "2/3-Mez": "030", "G": "002", "Ground": "002",
}
UNKNOWN_CODE = "000"
SOURCE_SYSTEM = "3"
DATA_OWNERSHIP = "3"


def _owner():
    return F.lit(SOURCE_SYSTEM).alias("F_SOURCE_SYSTEM"), F.lit(DATA_OWNERSHIP).alias("F_DATA_OWNERSHIP")


@zone_free_views
def units_feed(property_index: DataFrame, building: DataFrame, area: DataFrame) -> DataFrame:
    """Units of buildings that lie in a known area, with occupancy and floor decoded.

    As in SQL Server, blanks at the end do not count when building names, states or floors are compared.

    Buildings and areas are joined first, so that the units, the largest of the three, move once.
    """
    located = building.join(area.select(F.col("ID").alias("_area")), F.col("area_") == F.col("_area"))
    u, b = property_index.alias("u"), located.alias("b")
    joined = u.join(b, F.rtrim("u.Building") == F.rtrim("b.name_"))
    col = lambda name: F.col(f"u.`{name}`")
    return joined.select(
        F.lit("Units").alias("B_CLASSNAME"),
        F.col("b.buildingRef_").alias("F_BLOCKS"),
        col("Property Code").alias("UNITS_ID"),
        col("Property Name").alias("PROPERTY_NAME"),
        col("Full Address").alias("SHORT_ADDRESS"),
        col("Property Number").alias("GEOADDRESS1"),
        col("Address Line1").alias("GEOADDRESS2"),
        col("Address Line2").alias("GEOADDRESS3"),
        col("Street").alias("GEOTOWN"),
        col("Postcode").alias("GEOPOSTCODE"),
        isnull_default(col("Bedrooms"), property_index.schema["Bedrooms"].dataType.simpleString()).alias("NO_OF_BEDROOMS"),
        decode_like(col("Property Status"), OCCUPANCY_CODES, UNKNOWN_CODE).alias("OCCUPANCY_STATUS"),
        decode(col("Floor"), FLOOR_CODES, UNKNOWN_CODE, padded=True).alias("FLOOR_LEVEL"),
        col("Comments").alias("ANY_OTHER_INFORMATION"),
        *_owner(),
        sha1_null_marked(
            F.col("b.buildingRef_"), col("Property Code"), col("Property Name"), col("Full Address"),
            col("Property Number"), col("Address Line1"), col("Address Line2"), col("Street"), col("Postcode"),
            col("Comments"),
        ).alias("HASH_VALUE"),
    )


@zone_free_views
def blocks_feed(building: DataFrame, area: DataFrame, address: DataFrame) -> DataFrame:
    """Buildings of known areas, with their address where they have one."""
    b, a, d = building.alias("b"), area.alias("a"), address.alias("d")
    joined = b.join(a, F.col("b.area_") == F.col("a.ID")).join(d, F.col("b.address_") == F.col("d.ID"), "left")
    content = {
        "BLOCKS_ID": "b.buildingRef_",
        "BLOCK_NAME": "b.name_",
        "F_SCHEMES": "a.code_",
        "GEOADDRESS1": "d.line1_",
        "GEOADDRESS2": "d.line2_",
        "GEOTOWN": "d.line3_",
        "GEOPOSTCODE": "d.postcode_",
    }
    return joined.select(
        F.lit("Blocks").alias("B_CLASSNAME"),
        *[F.col(source).alias(name) for name, source in content.items()],
        *_owner(),
        row_hash(*content.values()).alias("HASH_VALUE"),
    )


@zone_free_views
def schemes_feed(area: DataFrame, *, estate: str) -> DataFrame:
    """Areas as schemes, all below one estate."""
    return area.select(
        F.lit("Schemes").alias("B_CLASSNAME"),
        F.col("code_").alias("SCHEMES_ID"),
        F.col("name_").alias("SCHEME_NAME"),
        F.lit(estate).alias("F_ESTATES"),
        *_owner(),
        row_hash("code_", "name_").alias("HASH_VALUE"),
    )
