"""Pinned schemas and table specs for the three layers.

Schemas are always explicit: an inferred schema costs an extra full pass over
the files and can silently change between loads.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# The raw results file's header, in file order.
RAW_COLUMNS = [
    "Year of event",
    "Event dates",
    "Event name",
    "Event distance/length",
    "Event number of finishers",
    "Athlete performance",
    "Athlete club",
    "Athlete country",
    "Athlete year of birth",
    "Athlete gender",
    "Athlete age category",
    "Athlete average speed",
    "Athlete ID",
]

_RAW_TYPES = {
    "Year of event": IntegerType(),
    "Event number of finishers": IntegerType(),
    "Athlete year of birth": DoubleType(),
    "Athlete ID": IntegerType(),
}

RAW_SCHEMA = StructType(
    [StructField(name, _RAW_TYPES.get(name, StringType()), True) for name in RAW_COLUMNS]
)

COUNTRY_SCHEMA = StructType(
    [
        StructField("iso_code", StringType(), True),
        StructField("country_name", StringType(), True),
    ]
)

#: Where a row lies in the stored bronze table (file and row number), while silver is derived.
ROW_PLACE = "stored_row_place"

# Column order of the silver one-big-table.
SILVER_COLUMNS = [
    "year_of_event",
    "event_dates",
    "event_name",
    "event_number_of_finishers",
    "athlete_club",
    "athlete_country",
    "athlete_year_of_birth",
    "athlete_gender",
    "athlete_age_category",
    "athlete_average_speed",
    "athlete_id",
    "is_estimated_date",
    "event_start_date",
    "event_end_date",
    "event_country_code",
    "event_name_cleaned",
    "event_country_name",
    "athlete_country_name",
    "event_type",
    "duration_h",
    "distance_km",
    "speed_km_h",
    "athlete_age",
    "event_id",
    "result_id",
]


@dataclass(frozen=True)
class TableSpec:
    name: str
    layer: str
    comment: str
    technical: tuple[str, ...] = ()  # columns of the stored files that are not the table's


TABLES = {
    spec.name: spec
    for spec in [
        TableSpec("raw_marathon", "bronze", "Raw race results as delivered"),
        TableSpec("dim_countries", "bronze", "Country codes and names", ("ingested_at",)),
        TableSpec("marathon_obt", "silver", "Cleaned race results, one row per performance", ("batch",)),
        TableSpec("fct_results", "gold", "Fact table: one row per performance"),
        TableSpec("dim_athlete", "gold", "Athlete dimension"),
        TableSpec("dim_event", "gold", "Event dimension"),
        TableSpec("dim_date", "gold", "Date dimension"),
        TableSpec("mart_distance", "gold", "Distance-event mart"),
        TableSpec("mart_time", "gold", "Time-event mart"),
    ]
}
