"""Event name text -> cleaned name and ISO-3 country code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stridelake.functions import rules as R


def country_code(name: Column) -> Column:
    """Trailing ``(ABC)`` code; '' when there is none."""
    return F.regexp_extract(name, R.COUNTRY_CODE, 1)


def cleaned_name(name: Column) -> Column:
    """Name without its code suffix and outer blanks/quotes; doubled quotes
    (CSV escaping left in the text) collapse to one."""
    before_code = F.regexp_extract(name, R.NAME_BEFORE_CODE, 1)
    whole = F.regexp_replace(name, R.OUTER_BLANKS_AND_QUOTES, "")
    chosen = F.when(before_code != "", before_code).otherwise(whole)
    return F.replace(chosen, F.lit(R.DOUBLED_QUOTE), F.lit('"'))


def is_global_event(name: Column) -> Column:
    return name.contains(R.GLOBAL_EVENT_MARK)
