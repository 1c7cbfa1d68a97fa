"""Silver cleaning steps, each a DataFrame -> DataFrame function for ``df.transform``.

Every step works unchanged on a batch or a streaming DataFrame (they are
stateless row maps plus a lookup join against a small static table).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.functions import dates, names, people
from stridelake.functions import performance as perf
from stridelake.functions import rules as R
from stridelake.operators.lookup import CodeLookup, add_country_name
from stridelake.schemas import ROW_PLACE


def normalize_event_dates(df: DataFrame, date_col: str = "event_dates") -> DataFrame:
    """Add ``is_estimated_date``, ``event_start_date``, ``event_end_date``."""
    raw = F.col(date_col)
    return (
        df.withColumns({"__start": dates.start_text(raw), "__end": dates.end_text(raw)})
        .withColumns(
            {
                "is_estimated_date": dates.is_estimated(F.col("__start"), F.col("__end")),
                "event_start_date": dates.parse_day(F.col("__start")),
                "event_end_date": dates.parse_day(F.col("__end")),
            }
        )
        .drop("__start", "__end")
    )


def parse_event_names(df: DataFrame, name_col: str = "event_name") -> DataFrame:
    """Add ``event_country_code`` and ``event_name_cleaned``."""
    raw = F.col(name_col)
    return df.withColumns(
        {"event_country_code": names.country_code(raw), "event_name_cleaned": names.cleaned_name(raw)}
    )


def add_event_country(df: DataFrame, lookup: CodeLookup) -> DataFrame:
    return add_country_name(df, lookup, "event_country_code", "event_country_name")


def add_athlete_country(df: DataFrame, lookup: CodeLookup) -> DataFrame:
    return add_country_name(df, lookup, "athlete_country", "athlete_country_name")


def mark_global_events(df: DataFrame, name_col: str = "event_name") -> DataFrame:
    """Races run world-wide at once get country "Global"/GLO (event side only)."""
    is_global = names.is_global_event(F.col(name_col))
    return df.withColumns(
        {
            "event_country_name": F.when(is_global, F.lit(R.GLOBAL_COUNTRY_NAME)).otherwise(
                F.col("event_country_name")
            ),
            "event_country_code": F.when(is_global, F.lit(R.GLOBAL_COUNTRY_CODE)).otherwise(
                F.col("event_country_code")
            ),
        }
    )


def add_performance_metrics(
    df: DataFrame,
    distance_col: str = "event_distance_length",
    performance_col: str = "athlete_performance",
    name_col: str = "event_name",
) -> DataFrame:
    """Add ``event_type``, ``duration_h``, ``distance_km``, ``speed_km_h`` and drop
    the two raw text columns they replace.

    Every regex result is materialised by its own projection stage and later
    stages read it as a column, so each regex runs exactly once per row
    (inlined into CASE branches it would be re-evaluated: common-subexpression
    elimination does not reach into conditional branches).
    """
    col = F.col
    perf_raw = col(performance_col)
    parts = ["days", "hours", "minutes", "seconds"]
    scratch = ["__walk", "__lead", "__unit", "__text", "__value", "__amount_text", "__clock",
               "__amount", "__ev_km", "__ev_h", "__own_km"] + [f"__{p}" for p in parts]
    # The athlete's own hours are a cheap CASE over columns: inlined (twice)
    # into duration rather than staged.  Rounded values are staged: ``round``
    # goes through BigDecimal and is worth computing once.
    own_hours = perf.athlete_hours(col("__walk"), col("event_type"), col("__clock"))
    return (
        df.withColumns(
            {
                "__walk": perf.is_walk(col(name_col)),
                "__lead": perf.event_lead(col(distance_col)),
                "__unit": perf.event_unit(col(distance_col)),
                "__text": perf.performance_text(perf_raw),
            }
        )
        .withColumns(
            {
                "event_type": perf.event_type(col("__walk"), col("__unit")),
                "__value": perf.event_value(col("__lead")),
                "__amount_text": perf.reached_text(col("__text")),
                **{f"__{k}": v for k, v in perf.clock_parts(col("__text")).items()},
            }
        )
        .withColumns(
            {
                "__clock": perf.clock_total(*(col(f"__{p}") for p in parts)),
                "__amount": perf.reached_amount(col("__amount_text")),
                "__ev_km": perf.event_km(col("__unit"), col("__value")),
                "__ev_h": perf.event_hours(col("__unit"), col("__value")),
            }
        )
        .withColumns(
            {
                "duration_h": perf.duration_h(col("__walk"), col("__ev_h"), own_hours),
                "__own_km": perf.athlete_km(perf_raw, col("event_type"), col("__amount")),
            }
        )
        .withColumn(
            "distance_km",
            perf.distance_km(col("__walk"), col("duration_h"), col("__ev_km"), col("__own_km")),
        )
        .withColumn("speed_km_h", perf.speed_km_h(col("__walk"), col("distance_km"), col("duration_h")))
        .drop(*scratch, distance_col, performance_col)
    )


def normalize_gender(df: DataFrame, col: str = "athlete_gender") -> DataFrame:
    return df.withColumn(col, people.gender(F.col(col)))


def normalize_age_category(df: DataFrame, col: str = "athlete_age_category") -> DataFrame:
    return df.withColumn(col, people.age_category(F.col(col)))


def add_athlete_identity(df: DataFrame) -> DataFrame:
    """Replace the recycled raw ``athlete_id`` by a stable hash key."""
    return df.withColumn(
        "athlete_id",
        people.athlete_key(
            F.col("athlete_id"),
            F.col("athlete_gender"),
            F.col("athlete_country_name"),
            F.col("athlete_year_of_birth"),
        ),
    )


def add_athlete_age(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "athlete_age", people.age_at_event(F.col("year_of_event"), F.col("athlete_year_of_birth"))
    )


def hold(df: DataFrame, columns: list[str]) -> DataFrame:
    """The same rows, with the parsing of ``columns`` done before what follows.

    Catalyst would move a filter on parsed columns below the parsing and write
    every regex out again inside it (an expression too large to compile).  It
    takes such a filter past no column that a generator makes, so the columns go
    through a one-element ``inline``.  That is deterministic: filters on all other
    columns still reach the scan, and columns that nobody reads are still pruned.
    """
    others = [c for c in df.columns if c not in columns]
    return df.select(*others, F.inline(F.array(F.struct(*columns)))).select(*df.columns)


MEASURES = ["distance_km", "speed_km_h", "duration_h"]


def is_incomplete() -> Column:
    return F.col("distance_km").isNull() | F.col("speed_km_h").isNull() | F.col("duration_h").isNull()


def gate_metrics() -> list[Column]:
    """Rows entering the quality gate and how many fail each rule."""
    age, speed = F.col("athlete_age"), F.col("speed_km_h")
    return [
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(is_incomplete()).alias("incomplete"),
        F.count_if(age < R.MIN_AGE).alias("under_min_age"),
        F.count_if(age > R.MAX_AGE).alias("over_max_age"),
        F.count_if(speed > R.MAX_SPEED_KMH).alias("over_max_speed"),
    ]


def is_plausible() -> Column:
    """Distance, speed and duration known; age 15..100 or unknown; speed at most the marathon world record."""
    age, speed = F.col("athlete_age"), F.col("speed_km_h")
    return ~is_incomplete() & (age.between(R.MIN_AGE, R.MAX_AGE) | age.isNull()) & (speed <= R.MAX_SPEED_KMH)


def quality_gate(df: DataFrame) -> DataFrame:
    """Keep complete rows of plausible athletes."""
    return hold(df, [*MEASURES, "athlete_age"]).filter(is_plausible())


def add_keys(df: DataFrame) -> DataFrame:
    """``event_id`` (hash of raw name and year) and ``result_id``.

    Rows that carry their place in the stored bronze table (``ROW_PLACE``, see
    ``sources.files.with_row_place``) get an id of that place: a repeated task gives the
    same ids, and filters pass it on their way to the scan.  Other rows get a
    random id, which is only stable once written.
    """
    result_id = people.uuid_of(F.col(ROW_PLACE)) if ROW_PLACE in df.columns else F.expr("uuid()")
    return df.withColumns({"event_id": people.event_key(F.col("event_name"), F.col("year_of_event")), "result_id": result_id})
