"""Event date text -> start date, end date and an "estimated" flag.

Raw dates come as a single day (``dd.MM.yyyy``) or as a range in one of three
shapes (``dd.-dd.MM.yyyy``, ``dd.MM[.]-dd.MM.yyyy``, ``dd.MM.yyyy-dd.MM.yyyy``).
Unknown day or month parts are written ``00`` and become ``01`` plus a flag.
Anything unparsable yields null, never an error (ANSI-safe ``try_to_date``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stridelake.functions import rules as R

# The three range shapes, each with its first day (or what completes it) in groups.
DAY_RANGE = r"^(\d{2})\.-\d{2}\.(\d{2}\.\d{4})$"
MONTH_RANGE = r"^(\d{2}\.\d{2})\.?-\d{2}\.\d{2}\.(\d{4})$"
YEAR_RANGE = r"^(\d{2}\.\d{2}\.\d{4})-\d{2}\.\d{2}\.\d{4}$"


def start_text(dates: Column) -> Column:
    """First day of the event, as ``dd.MM.yyyy`` text when the shape is known.

    Each range shape is rewritten to its first day; the shapes exclude each
    other and a rewrite never produces another range, so the rewrites chain.
    Text in no known shape passes through unchanged.
    """
    out = F.regexp_replace(dates, DAY_RANGE, "$1.$2")
    out = F.regexp_replace(out, MONTH_RANGE, "$1.$2")
    out = F.regexp_replace(out, YEAR_RANGE, "$1")
    # Every range shape contains "-": single days skip the three regexes.
    return F.when(dates.contains("-"), out).otherwise(dates)


def end_text(dates: Column) -> Column:
    """Last day of a range ('' when a range has no full trailing date); a
    single-day text is its own end."""
    return F.when(dates.contains("-"), F.regexp_extract(dates, R.LAST_FULL_DATE, 1)).otherwise(dates)


def is_estimated(start: Column, end: Column) -> Column:
    """True when either side carries an unknown ``00`` part (null -> false)."""
    return F.coalesce(
        start.contains(R.UNKNOWN_PART_TEXT) | end.contains(R.UNKNOWN_PART_TEXT), F.lit(False)
    )


def parse_day(text: Column) -> Column:
    """``dd.MM.yyyy`` text -> DATE, unknown parts read as 01; bad text -> null."""
    filled = F.replace(text, F.lit(R.UNKNOWN_PART_TEXT), F.lit(R.UNKNOWN_PART_REPLACEMENT))
    return F.try_to_date(filled, R.DATE_FORMAT)


def date_key(day: Column) -> Column:
    """DATE -> yyyyMMdd as BIGINT (arithmetic, no string round trip)."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("bigint")
