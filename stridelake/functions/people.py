"""Athlete attributes: gender, age category, stable identity, age."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stridelake.functions import rules as R


def gender(raw: Column) -> Column:
    """First letter of the trimmed upper-cased text if it is M, F or X; else U."""
    first = F.substring(F.trim(F.upper(raw)), 1, 1)
    return F.when(first.isin(*R.GENDERS), first).otherwise(F.lit(R.UNKNOWN_GENDER))


def age_category(raw: Column) -> Column:
    """Upper-case, trimmed; missing -> Unknown; women's classes start with W."""
    tidy = F.coalesce(F.trim(F.upper(raw)), F.lit(R.UNKNOWN_LABEL))
    return F.regexp_replace(tidy, R.WOMEN_PREFIX_IN, R.WOMEN_PREFIX_OUT)


def athlete_key(raw_id: Column, gender_: Column, country_name: Column, birth_year: Column) -> Column:
    """SHA-256 of id, gender, country and birth year: raw IDs are recycled
    between people, the combination is not.  A null raw id is skipped by
    ``concat_ws``; the other parts fall back to UNKNOWN."""
    unknown = F.lit(R.KEY_UNKNOWN)
    return F.sha2(
        F.concat_ws(
            R.KEY_SEPARATOR,
            raw_id.cast("string"),
            F.coalesce(gender_, unknown),
            F.coalesce(country_name, unknown),
            F.coalesce(birth_year.cast("string"), unknown),
        ),
        256,
    )


def event_key(raw_event_name: Column, year: Column) -> Column:
    """SHA-256 of the raw event name and the year."""
    return F.sha2(F.concat_ws(R.KEY_SEPARATOR, raw_event_name, year.cast("string")), 256)


def uuid_of(place: Column) -> Column:
    """A UUID-shaped text of what tells a row apart from all others."""
    digest = F.md5(place)
    return F.concat_ws("-", *[F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def age_at_event(year: Column, birth_year: Column) -> Column:
    return year - birth_year
