"""Mart questions, each in a hand-written (a) and an alternative (b) formulation.

Every function takes the mart DataFrame(s) and returns a small result.
Queries with a LIMIT order by their documented keys first and then by every
output column, so the rows kept are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.operators.profile import stats_with_median



def _total_order(df: DataFrame, first: list[Column]) -> list[Column]:
    """``first`` keys, then every output column ascending (nulls first)."""
    return first + [F.col(c).asc_nulls_first() for c in df.columns]


def q1a_events_by_country(mart_time: DataFrame) -> DataFrame:
    """Distinct events per event country."""
    return (
        mart_time.groupBy("event_country")
        .agg(F.countDistinct("event").alias("Events"))
        .orderBy(F.col("Events").desc())
    )


def q1b_events_by_country_nn(mart_time: DataFrame) -> DataFrame:
    return (
        mart_time.filter(F.col("event_country").isNotNull())
        .groupBy("event_country")
        .agg(F.countDistinct("event").alias("event_count"))
        .orderBy(F.col("event_count").desc())
    )


def q2a_age_stats(mart_time: DataFrame) -> DataFrame:
    age = F.col("athlete_age")
    return mart_time.agg(
        F.min(age).alias("min_age"),
        F.max(age).alias("max_age"),
        F.mean(age).alias("mean_age"),
        F.avg(age).alias("average_age"),
    )


def q2b_age_stats_median(mart_time: DataFrame) -> DataFrame:
    """Age distribution with the median, via a value histogram (see
    :func:`stridelake.operators.profile.stats_with_median`)."""
    names = {"min": "min_age", "max": "max_age", "mean": "avg_age", "median": "median_age"}
    return stats_with_median(mart_time, "athlete_age", names)


def _full_day(mart_time: DataFrame) -> DataFrame:
    return mart_time.filter(F.col("event_time_h") == 24)


def q3a_longest_24h(mart_time: DataFrame) -> DataFrame:
    return _full_day(mart_time).agg(F.max("athlete_distance_km").alias("max_distance_km"))


def q3b_top10_24h(mart_time: DataFrame) -> DataFrame:
    rows = _full_day(mart_time).select(
        "athlete_distance_km",
        "event",
        "event_country",
        "date",
        "athlete_gender",
        "athlete_country",
        "athlete_age",
        "event_time_h",
        F.round(F.col("athlete_distance_km") / F.col("event_time_h"), 2).alias("speed_km_h"),
    )
    # Top-k: planned as TakeOrderedAndProject (per-partition top 10, then a merge).
    return rows.orderBy(*_total_order(rows, [F.col("athlete_distance_km").desc_nulls_last()])).limit(10)


def _hundred_km(mart_distance: DataFrame) -> DataFrame:
    return mart_distance.filter(F.col("event_distance") == 100)


def q4a_best_100km(mart_distance: DataFrame) -> DataFrame:
    return _hundred_km(mart_distance).agg(F.min("athlete_time_h").alias("best_time"))


def q4b_best_100km_by_gender(mart_distance: DataFrame) -> DataFrame:
    return (
        _hundred_km(mart_distance)
        .filter(F.col("athlete_time_h").isNotNull() & F.col("athlete_gender").isin("M", "F"))
        .groupBy("athlete_gender")
        .agg(F.min("athlete_time_h").alias("best_time_h"))
        .orderBy("best_time_h")
    )


def _fifty_km(mart_distance: DataFrame) -> DataFrame:
    return mart_distance.filter(F.col("event_distance") == 50)


def _speed_of(gender: str) -> Column:
    return F.when(F.col("athlete_gender") == gender, F.col("athlete_speed_km_h"))


def gender_gap_sql(mart: str) -> str:
    """The gap in SQL over a named mart: filtered aggregates, their aliases used again in the same select list, and a filtered aggregate in HAVING."""
    speed = "avg(athlete_speed_km_h) FILTER (WHERE athlete_gender = '{}')"
    men, women = speed.format("M"), speed.format("F")
    return f"""
        SELECT event_year, round({men}, 2) AS avg_male_speed, round({women}, 2) AS avg_female_speed,
               round(avg_male_speed - avg_female_speed, 2) AS Differens
        FROM {mart} WHERE event_distance = 50
        GROUP BY event_year HAVING {women} IS NOT NULL ORDER BY event_year"""


def q5a_gender_gap_50km(mart_distance: DataFrame) -> DataFrame:
    """Average speed by gender per year; the gap subtracts the rounded averages."""
    return mart_distance.sparkSession.sql(gender_gap_sql("{mart}"), mart=mart_distance)


def q5b_gender_gap_50km(mart_distance: DataFrame) -> DataFrame:
    """Same question; the gap rounds the difference of the unrounded averages."""
    per_year = (
        _fifty_km(mart_distance)
        .filter(F.col("athlete_gender").isin("M", "F") & F.col("athlete_speed_km_h").isNotNull())
        .groupBy("event_year")
        .agg(F.avg(_speed_of("M")).alias("m"), F.avg(_speed_of("F")).alias("f"))
        .filter(F.col("f").isNotNull())
    )
    return per_year.select(
        "event_year",
        F.round("m", 2).alias("male_speed"),
        F.round("f", 2).alias("female_speed"),
        F.round(F.col("m") - F.col("f"), 2).alias("speed_difference"),
    ).orderBy("event_year")


def _women_fifty_km(mart_distance: DataFrame) -> DataFrame:
    return _fifty_km(mart_distance).filter(F.col("athlete_gender") == "F")


def q6a_women_50km_by_year(mart_distance: DataFrame) -> DataFrame:
    return (
        _women_fifty_km(mart_distance)
        .groupBy("event_year")
        .agg(F.count_if(F.col("athlete_gender") == "F").alias("nr_female"))
        .orderBy("event_year")
    )


def q6b_first_women_50km(mart_distance: DataFrame) -> DataFrame:
    rows = _women_fifty_km(mart_distance).filter(F.col("athlete_speed_km_h").isNotNull()).select(
        "event_year",
        "date",
        "event",
        "event_country",
        "athlete_country",
        "athlete_age",
        "athlete_time_h",
        "athlete_speed_km_h",
    )
    first = [F.col("event_year").asc_nulls_first(), F.col("date").asc_nulls_first()]
    return rows.orderBy(*_total_order(rows, first)).limit(10)


def _smoke(
    fact: DataFrame, events: DataFrame, athletes: DataFrame, days: DataFrame, event_type: str, measure: list[Column]
) -> DataFrame:
    e = events.filter(F.col("event_type") == event_type).alias("e")
    rows = (
        fact.alias("r")
        .join(e, F.col("r.event_id") == F.col("e.event_id"))
        .join(athletes.alias("a"), F.col("r.athlete_id") == F.col("a.athlete_id"))
        .join(days.alias("d"), F.col("r.date_id") == F.col("d.date_id"))
        .select(
            F.col("e.event_name"),
            F.col("e.event_country_name"),
            measure[0],
            F.col("e.event_type"),
            F.col("d.year"),
            F.col("a.athlete_gender"),
            F.col("r.athlete_age_category"),
            measure[1],
            F.col("r.result_speed_km_h"),
        )
    )
    return rows.orderBy(*_total_order(rows, [])).limit(50)


def smoke_mart_time(fact: DataFrame, events: DataFrame, athletes: DataFrame, days: DataFrame) -> DataFrame:
    """Star-join smoke check for Time events (50 rows)."""
    measure = [F.col("r.result_time_h").alias("time_h"), F.col("r.result_distance_km")]
    return _smoke(fact, events, athletes, days, "Time", measure)


def smoke_mart_distance(fact: DataFrame, events: DataFrame, athletes: DataFrame, days: DataFrame) -> DataFrame:
    """Star-join smoke check for Distance events (50 rows)."""
    measure = [F.col("r.result_distance_km").alias("distance"), F.col("r.result_time_h")]
    return _smoke(fact, events, athletes, days, "Distance", measure)


def preview_dim_date(dim_date: DataFrame) -> DataFrame:
    """First 50 calendar rows, in date order."""
    rows = dim_date.select(
        F.col("date_id").alias("datetime_id"),
        F.col("date").alias("datetime"),
        "year",
        "month",
        "weekday",
    )
    return rows.orderBy(F.col("datetime_id").asc_nulls_first()).limit(50)
