"""The residents feed: a projection of one view with its date texts parsed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import parse_oracle_date, unparsed
from tidemark.plans.rejects import reject_marks

# The staging table's columns in order, and which of them are dates.
COLUMNS = [
    "HOUSE_SIZE", "RESIDENTS_ID", "HOUSE_REF", "AGREEMENT_REF", "AGREEMENT_DESC", "START_OF_TERM",
    "END_OF_TERM", "CURRENT_OCCUPANT", "STOCK_GROUP", "OCCUPANCY_TERMINATED", "RENT_VALUE",
    "OCCUPANCY_STATUS", "CURRENT_BALANCE", "SCH_VALUE", "RESIDENT_TYPE", "F_RENT_GRP_REF", "F_UNITS",
    "F_PROPERTY_TYPE", "F_TENURE_TYPE", "B_CLASSNAME", "B_CREDATE", "B_CREATOR", "F_SOURCE_SYSTEM",
    "F_DATA_OWNERSHIP", "HASH_VALUE",
]
DATES = ("START_OF_TERM", "END_OF_TERM", "B_CREDATE")


def residents_feed(
    view: DataFrame, *, current_year: int = 2000, strict: bool = False, rejects: bool = False
) -> DataFrame:
    """The view's columns, dates parsed. A text that is no date becomes NULL, or an error with `strict`.

    With `rejects`, such texts are marked besides, and a load splits their rows off.
    """
    dates = {c: parse_oracle_date(F.col(c), current_year=current_year, strict=strict) for c in DATES}
    marks = [reject_marks({c: (F.col(c), parsed) for c, parsed in dates.items()})] if rejects else []
    return view.select(*[dates[c].alias(c) if c in dates else F.col(c).alias(c) for c in COLUMNS], *marks)


def residents_bad_dates(view: DataFrame, *, current_year: int = 2000) -> DataFrame:
    """How many texts of each date column are no dates, as one row."""
    return view.agg(*[
        unparsed(F.col(c), parse_oracle_date(F.col(c), current_year=current_year)).alias(c) for c in DATES
    ])
