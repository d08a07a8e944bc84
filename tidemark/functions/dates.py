"""Dates: validity windows, day-month-name texts, and text clean-up.

Times are zone-less (`timestamp_ntz`) throughout, so no result here depends on the session's time zone.
The current time is an argument: a caller passes one `as_of` for the whole load.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names, the forms of a date that text columns hold, and the form `DD-MON-RRRR HH:MI:SS` with a four-digit year, time part optional.
MONTHS = ["JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"]
MONTH_NAMES = (
    "JAN(?:UARY)?|FEB(?:RUARY)?|MAR(?:CH)?|APR(?:IL)?|MAY|JUNE?|JULY?|AUG(?:UST)?|SEP(?:TEMBER)?|OCT(?:OBER)?|"
    "NOV(?:EMBER)?|DEC(?:EMBER)?"
)
TEXT_DATES = [
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{8}$", "yyyyMMdd"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
    (r"^[A-Za-z]{3} \d{1,2} \d{4}$", "MMM d yyyy"),
]
TIME_OF_DAY = r" \d{1,2}:\d{2}(?::\d{2})?(?:[.:]\d+)? ?(?:[AaPp][Mm])?$"
DAY_MONTH_NAME = r"^(\d{1,2})-([A-Z]{3})-(\d{4})(?: +((?:0?[1-9]|1[0-2]):\d{1,2}:\d{1,2}))?$"

VALID_DAYS_BACK = 1
VALID_MONTHS_AHEAD = 100


Instant = str | dt.datetime | Column


def as_timestamp(as_of: Instant) -> Column:
    """The time of the load as a zone-less timestamp."""
    value = as_of if isinstance(as_of, Column) else F.lit(str(as_of))
    return value.cast("timestamp_ntz")


def validity_window(as_of: Column) -> tuple[Column, Column]:
    """From one day before to a hundred months after `as_of`, keeping its time of day."""
    start = as_of - F.expr(f"INTERVAL {VALID_DAYS_BACK} DAY")
    end = as_of + F.expr(f"INTERVAL {VALID_MONTHS_AHEAD} MONTH")
    return start, end


def parse_oracle_date(col: Column, *, current_year: int = 2000, strict: bool = False) -> Column:
    """Text in the form `DD-MON-RRRR HH:MI:SS` as a timestamp.

    The hour runs from 1 to 12 and is taken as a.m., so 12 is midnight; without a time part it is
    midnight too. A two-digit year is put in the century of `current_year` or its neighbour,
    whichever the rule of fifty gives: 00-49 means the current century (the next, if the current year
    is in its second half), and 50-99 the previous one (the current, if in its second half). Text
    that is no such date gives NULL, or an error with `strict`.

    The text is rewritten as an ISO timestamp and cast. That keeps the expression small: a view with
    several dates still compiles to code the JVM optimises.
    """
    century = current_year // 100
    low, high = (century + 1, century) if current_year % 100 >= 50 else (century, century - 1)

    # Any punctuation may part the date, and months may be written out.
    text = F.regexp_replace(
        F.upper(F.trim(col)),
        rf"^(\d{{1,2}})[-/., ]+(?=(?:{MONTH_NAMES})[-/., ])([A-Z]{{3}})[A-Z]*[-/., ]+(\d{{2}}|\d{{4}})(?= |$)", "$1-$2-$3")
    text = F.regexp_replace(text, r"(?<=-)(?=[0-4]\d(?: |$))", str(low))
    text = F.regexp_replace(text, r"(?<=-)(?=[5-9]\d(?: |$))", str(high))
    # Year first, the month name marked by small letters, which no text has that does not match.
    turned = F.regexp_replace(text, DAY_MONTH_NAME, "$3m$2m$1 $4")
    month = F.array_position(F.array(*[F.lit(f"m{name}m") for name in MONTHS]), F.substring(turned, 5, 5))
    midnight = F.replace(turned, F.lit(" 12:"), F.lit(" 00:"))
    number = F.concat(F.lit("-"), month.cast("string"), F.lit("-"))
    parsed = F.overlay(midnight, number, F.lit(5), F.lit(5)).try_cast("timestamp_ntz")
    if strict:
        bad = parsed.isNull() & col.isNotNull()
        message = F.concat(F.lit("not a date of the form DD-MON-RRRR HH:MI:SS: "), col)
        return F.when(bad, F.raise_error(message).cast("timestamp_ntz")).otherwise(parsed)
    return parsed


def unparsed(text: Column, parsed: Column) -> Column:
    """Number of texts that gave no date, as an aggregate."""
    return F.count_if(text.isNotNull() & parsed.isNull())


def format_twelve_hour(ts: Column) -> Column:
    """`YYYY-MM-DD HH:MI:SS` with the hour from 1 to 12 and no a.m. or p.m."""
    text = ts.cast("timestamp_ntz").cast("string")
    hour = F.lpad(((F.hour(ts) + 11) % 12 + 1).cast("string"), 2, "0")
    return F.concat(F.substring(text, 1, 11), hour, F.substring(text, 14, 6))


def text_to_date(col: Column) -> Column:
    """Padded text as a date; blank text is 1900-01-01, as in SQL Server, and text that is no date NULL.

    Taken are `2001-03-15`, `20010315`, `15 Mar 2001` and `Mar 15 2001`, each with or without a time of day,
    which is what a date or time turned into text looks like there.
    """
    text = F.regexp_replace(F.trim(col.cast("string")), " +", " ")
    text = F.regexp_replace(text, TIME_OF_DAY, "")
    case = F.when(text == "", F.to_date(F.lit("1900-01-01")))
    for pattern, form in TEXT_DATES:
        case = case.when(text.rlike(pattern), F.try_to_date(text, form))
    return case


def text_or_default_date(col: Column) -> Column:
    """`text_to_date`, NULL like blank text being 1900-01-01; text that is no date stays NULL and can be counted."""
    return F.when(col.isNull(), F.to_date(F.lit("1900-01-01"))).otherwise(text_to_date(col))
