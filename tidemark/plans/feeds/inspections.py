"""The estate inspection feed: one view of padded texts, cleaned and numbered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.cleaning import blank_to_null, equals_padded, isnull_default, rtrim_text
from tidemark.functions.dates import Instant, as_timestamp, text_or_default_date, text_to_date, unparsed
from tidemark.functions.hashing import row_hash, zone_free_views
from tidemark.operators.numbering import global_row_number
from tidemark.plans.rejects import reject_marks

KEY = "ESTATE_INSP_AND_CLEANING_"

# Contractor names and their ids, the staging table's columns with the view's column and
# treatment of each, and the columns whose change makes a new version.
GROUNDS_CONTRACTOR, GROUNDS_CONTRACTOR_ID = "Just Ask", 1
CLEANING_CONTRACTOR, CLEANING_CONTRACTOR_ID = "Cleanscapes", 4
OTHER_CONTRACTOR_ID = 21
COLUMNS = [
    ("FD_SCHEMES", "prop_ref", "text"),
    ("RESIDENT_INSPECTOR", "resident_inspector", "text"),
    ("PRIORITY", "inspection_priority", "text"),
    ("FD_CONTRACTOR_INSP", "grounds_contractor", "grounds contractor"),
    ("GROUNDS_TEAM", "grounds_team", "team"),
    ("FD_CONTRACTOR_CLEANING", "cleaning_contractor", "cleaning contractor"),
    ("CLEANING_TEAM", "cleaning_team", "team"),
    ("STAFF_GROUNDS_COUNT", "staff_grounds_cnt", "text"),
    ("STAFF_GROUNDS_LASTDATE", "staff_grounds_last_date", "date"),
    ("STAFF_CLEANING_COUNT", "staff_cleaning_cnt", "text"),
    ("LAST_CLEANING_DATE", "staff_cleaning_last_date", "date"),
    ("GROUND_STATUS", "grounds_status", "text"),
    ("GROUNDS_DUE", "grounds_due", "date"),
    ("CLEANING_STATUS", "cleaning_status", "text"),
    ("CLEANING_DUE", "cleaning_due", "date"),
    ("RESIDENTS_COUNT", "resident_grounds_cnt", "text"),
    ("RESIDENT_GROUNDS_LAST_DAT", "resident_grounds_last_date", "date"),
    ("RESIDENTS_CLEANING_COUNT", "resident_cleaning_cnt", "text"),
    ("RESIDENT_CLEAN_LAST_DATE", "resident_cleaning_last_date", "date"),
]
HASHED = [source for _, source, _ in COLUMNS]
DATES = [source for _, source, treatment in COLUMNS if treatment == "date"]


def _contractor(col: Column, name: str, contractor_id: int) -> Column:
    return F.when(equals_padded(col, name), F.lit(contractor_id)).otherwise(F.lit(OTHER_CONTRACTOR_ID)).cast("string")


_TREATMENTS = {
    "text": lambda col: isnull_default(rtrim_text(col)),
    "team": lambda col: isnull_default(rtrim_text(blank_to_null(col))),
    "date": text_or_default_date,
    "grounds contractor": lambda col: _contractor(col, GROUNDS_CONTRACTOR, GROUNDS_CONTRACTOR_ID),
    "cleaning contractor": lambda col: _contractor(col, CLEANING_CONTRACTOR, CLEANING_CONTRACTOR_ID),
}


def inspections_bad_dates(view: DataFrame) -> DataFrame:
    """One row: for every date column, the number of texts that are no date and not blank."""
    return view.agg(*[unparsed(*_checked(c)).alias(c) for c in DATES])


def _checked(c: str) -> tuple[Column, Column]:
    """A date column's text, NULL where blank, and what it is read as."""
    return F.when(F.rtrim(c) != "", F.col(c)), text_to_date(F.col(c))


@zone_free_views
def inspections_feed(view: DataFrame, *, as_of: Instant, creator: str, rejects: bool = False) -> DataFrame:
    """The view's texts trimmed, blanks and NULL as '' or 1900-01-01, dates parsed, rows numbered by property reference.

    With `rejects`, texts that are no date are marked besides, and a load splits their rows off.
    """
    as_of = as_timestamp(as_of)
    numbered = global_row_number(view.select(*HASHED), ["prop_ref"], KEY)
    return numbered.select(
        KEY,
        *[_TREATMENTS[treatment](F.col(source)).alias(name) for name, source, treatment in COLUMNS],
        F.lit("EstateInspAndCleaning").alias("B_CLASSNAME"),
        row_hash(*HASHED).alias("HASH_VALUE"),
        as_of.alias("B_CREDATE"),
        F.lit(creator).alias("B_CREATOR"),
        *([reject_marks({c: _checked(c) for c in DATES})] if rejects else []),
    )
