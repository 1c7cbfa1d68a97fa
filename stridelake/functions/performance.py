"""Event distance/length + athlete performance -> type, duration, distance, speed.

A *Distance* event (km, k, mi, mile, miles, or any unknown unit) fixes the
distance and the athlete's text is a clock time; a *Time* event (h, d) fixes
the duration and the athlete's text is a distance; a walking event
(*Endurance*) is scored as the athlete's time at a fixed 5 km/h.

All parsing is ANSI-safe: malformed numbers become null, never an error.
Numbers are parsed as DOUBLE (the source parsed FLOAT; double avoids float
noise leaking into rounded results).

The builders are split so that a caller can materialise each intermediate
value once (see ``operators.cleaning.add_performance_metrics``): every
builder takes the previous stage's *columns*, never re-derives them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stridelake.functions import rules as R


def _number(text: Column) -> Column:
    """Text -> DOUBLE; '' and malformed text give null.

    The empty-text check comes first: '' is the common "no match" case and a
    failed cast is far more expensive than a comparison.
    """
    return F.when(text != "", text.try_cast("double"))


# Stage 1: text pieces of the raw columns.


def is_walk(event_name: Column) -> Column:
    return event_name.rlike(R.WALK_EVENT)


def event_lead(distance_text: Column) -> Column:
    """Leading amount of the event length ("12:30" of "12:30h"); '' if none."""
    return F.regexp_extract(distance_text, R.LEADING_AMOUNT, 1)


def event_unit(distance_text: Column) -> Column:
    """Unit letters right after the amount, lower-cased ("km", "h", ...)."""
    return F.lower(F.regexp_extract(distance_text, R.AMOUNT_UNIT, 1))


def performance_text(performance: Column) -> Column:
    """Athlete text without trailing unit letters/blanks ("4:51:39 h" -> "4:51:39")."""
    return F.trim(F.regexp_replace(performance, R.TRAILING_LETTERS, ""))


# Stage 2: numbers.


def event_value(lead: Column) -> Column:
    """"12:30" is 12 h 30 min; a plain amount is read as is."""
    parts = F.split(lead, ":")
    return F.when(
        lead.contains(":"), _number(F.get(parts, 0)) + _number(F.get(parts, 1)) / 60
    ).otherwise(_number(lead))


def event_type(walk: Column, unit: Column) -> Column:
    return (
        F.when(walk, F.lit(R.EVENT_ENDURANCE))
        .when(unit.isin(*R.TIME_UNITS), F.lit(R.EVENT_TIME))
        .otherwise(F.lit(R.EVENT_DISTANCE))
    )


def clock_parts(text: Column) -> dict[str, Column]:
    """Day, hour, minute and second fields of ``[Nd ]H:MM:SS`` as text ('' if absent)."""
    return {
        "days": F.regexp_extract(text, R.PERF_DAYS, 1),
        "hours": F.regexp_extract(text, R.PERF_HOURS, 1),
        "minutes": F.regexp_extract(text, R.PERF_MINUTES, 1),
        "seconds": F.regexp_extract(text, R.PERF_SECONDS, 1),
    }


def clock_total(days: Column, hours: Column, minutes: Column, seconds: Column) -> Column:
    """Clock fields -> hours, missing fields counting 0.

    ``4:45`` has no middle field and is read as 4 h 45 s, as in the source.
    """

    def part(text: Column) -> Column:
        return F.coalesce(_number(text), F.lit(0.0))

    return part(days) * R.HOURS_PER_DAY + part(hours) + part(minutes) / 60 + part(seconds) / 3600


def reached_text(text: Column) -> Column:
    """Leading number of the athlete text (a distance in Time events), as text."""
    return F.regexp_extract(text, R.LEADING_NUMBER, 1)


def reached_amount(amount_text: Column) -> Column:
    return _number(amount_text)


# Stage 3: event and athlete amounts in km / h.


def event_km(unit: Column, value: Column) -> Column:
    return F.when(unit.isin(*R.KM_UNITS), value).when(unit.isin(*R.MILE_UNITS), value * R.KM_PER_MILE)


def event_hours(unit: Column, value: Column) -> Column:
    return F.when(unit == "h", value).when(unit == "d", value * R.HOURS_PER_DAY)


def athlete_hours(walk: Column, etype: Column, clock: Column) -> Column:
    """The athlete's clock counts for Distance and walking events; 0 h is no time."""
    return F.when((etype == R.EVENT_DISTANCE) | walk, F.when(clock > 0, clock))


def athlete_km(performance: Column, etype: Column, amount: Column) -> Column:
    """Distance covered in a Time event, miles converted."""
    in_miles = F.lower(performance).contains(R.MILE_MARK)
    return F.when(etype == R.EVENT_TIME, F.when(in_miles, amount * R.KM_PER_MILE).otherwise(amount))


# Stage 4-6: results.


def duration_h(walk: Column, ev_hours: Column, own_hours: Column) -> Column:
    return F.round(F.when(walk, own_hours).otherwise(F.coalesce(ev_hours, own_hours)), 3)


def distance_km(walk: Column, duration: Column, ev_km: Column, own_km: Column) -> Column:
    return F.round(F.when(walk, duration * R.WALK_SPEED_KMH).otherwise(F.coalesce(ev_km, own_km)), 3)


def speed_km_h(walk: Column, distance: Column, duration: Column) -> Column:
    return F.when(walk, F.lit(R.WALK_SPEED_KMH)).otherwise(
        F.when(duration > 0, F.round(distance / duration, 2))
    )
