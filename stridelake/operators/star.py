"""Gold star schema: fact, three dimensions, two marts, and a key-uniqueness guard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridelake.functions import dates
from stridelake.functions import rules as R


def fact_results(silver: DataFrame) -> DataFrame:
    """One row per performance; a pure projection, so it also runs as a stream."""
    return silver.select(
        "result_id",
        "event_id",
        "athlete_id",
        "athlete_age",
        "athlete_age_category",
        F.col("duration_h").alias("result_time_h"),
        F.col("distance_km").alias("result_distance_km"),
        F.col("speed_km_h").alias("result_speed_km_h"),
        dates.date_key(F.col("event_start_date")).alias("date_id"),
    )


#: Columns of silver that a dimension is derived from.
DIMENSION_INPUTS = {
    "dim_athlete": ["athlete_id", "athlete_gender", "athlete_country_name", "athlete_year_of_birth"],
    "dim_event": ["event_id", "event_name_cleaned", "event_type", "year_of_event", "event_start_date", "event_end_date", "event_country_code", "event_country_name"],
    "dim_date": ["event_start_date"],
}


def dim_athlete(silver: DataFrame) -> DataFrame:
    return silver.select(
        "athlete_id",
        "athlete_gender",
        "athlete_country_name",
        F.col("athlete_year_of_birth").alias("athlete_birth_year"),
    ).distinct()


def dim_event(silver: DataFrame) -> DataFrame:
    """Distinct over all eight attributes, as in the source model.

    ``event_id`` ignores date, type and distance, so one key can have several
    rows (see :func:`key_violations`); the marts inherit that fan-out.
    """
    return silver.select(
        "event_id",
        F.col("event_name_cleaned").alias("event_name"),
        "event_type",
        "year_of_event",
        "event_start_date",
        "event_end_date",
        "event_country_code",
        "event_country_name",
    ).distinct()


def dim_date(silver: DataFrame) -> DataFrame:
    """One row per event start date.

    Dates are de-duplicated first (a one-column aggregate, partially combined
    map-side) and the calendar attributes are derived on the distinct set.
    """
    days = silver.select(F.col("event_start_date").alias("date")).filter(F.col("date").isNotNull()).distinct()
    return days.select(
        dates.date_key(F.col("date")).alias("date_id"),
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.date_format("date", "E").alias("weekday"),
    )


def key_violations(dim: DataFrame, key: str) -> DataFrame:
    """Keys with more than one row in a dimension (declared primary keys)."""
    return dim.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def _star(fact: DataFrame, events: DataFrame, athletes: DataFrame, days: DataFrame, event_type: str) -> DataFrame:
    # Inner equi-joins; AQE turns each into a broadcast join when the runtime
    # size of the dimension side is small, and splits skewed keys otherwise.
    # The type filter is pushed into the event dimension.
    # Ids are read here alone and go into the joins as bytes, half as wide as their hex digits.
    e = _with_bytes(events.filter(F.col("event_type") == event_type), "event_id").alias("e")
    a = _with_bytes(athletes, "athlete_id").alias("a")
    r = _with_bytes(_with_bytes(fact, "event_id"), "athlete_id").alias("r")
    return (
        r.join(e, _same_bytes("event_id", "e"))
        .join(a, _same_bytes("athlete_id", "a"))
        .join(days.alias("d"), F.col("r.date_id") == F.col("d.date_id"))
    )


def _with_bytes(df: DataFrame, key: str) -> DataFrame:
    """``key`` replaced by what tells it apart: 32 bytes if it is a digest of 64 lower-case
    hex digits, else its own bytes, and which of the two it is."""
    for name, text in _bytes_sql(key).items():
        df = df.withColumn(name, F.expr(text))
    return df.drop(key)


def _bytes_sql(key: str, null: str = "NULL") -> dict[str, str]:
    """The two columns as SQL, the second read off the first: a text is read once."""
    read = f"CASE WHEN length({key}) = 64 AND lower({key}) = {key} THEN coalesce(unhex({key}), CAST({key} AS BINARY), {null}) ELSE coalesce(CAST({key} AS BINARY), {null}) END"
    return {f"__{key}_bytes": read, f"__{key}_is_digest": f"coalesce(octet_length(__{key}_bytes) < octet_length({key}), false)"}


def distinct_by_bytes(df: DataFrame, *keys: str) -> DataFrame:
    """``df.distinct()``, for which ``keys`` are dealt out as bytes and written out again afterwards."""
    narrow = df
    for key in keys:
        narrow = _with_bytes(narrow, key)
    back = {key: F.when(F.col(f"__{key}_is_digest"), F.lower(F.hex(f"__{key}_bytes"))).otherwise(F.col(f"__{key}_bytes").cast("string")) for key in keys}
    return narrow.distinct().withColumns(back).select(*df.columns)


def _same_bytes(key: str, dim: str) -> Column:
    return (F.col(f"r.__{key}_bytes") == F.col(f"{dim}.__{key}_bytes")) & (F.col(f"r.__{key}_is_digest") == F.col(f"{dim}.__{key}_is_digest"))


def _columns(measure: tuple[str, str], athlete: tuple[str, str]) -> list[tuple[str, str]]:
    """(column of the star join, name in the mart); ``measure`` is what the event fixes, ``athlete`` what the athlete achieved."""
    return [
        ("e.event_name", "event"),
        ("e.event_country_name", "event_country"),
        (f"r.{measure[0]}", measure[1]),
        ("e.event_type", "event_type"),
        ("d.year", "event_year"),
        ("d.month", "event_month"),
        ("d.weekday", "event_weekday"),
        ("d.date", "date"),
        ("a.athlete_gender", "athlete_gender"),
        ("a.athlete_country_name", "athlete_country"),
        ("r.athlete_age", "athlete_age"),
        ("r.athlete_age_category", "athlete_age_category"),
        (f"r.{athlete[0]}", athlete[1]),
        ("r.result_speed_km_h", "athlete_speed_km_h"),
    ]


#: Mart: (type of race, columns).  In distance events athletes differ in time, in time events in distance.
MARTS = {
    "mart_distance": (R.EVENT_DISTANCE, _columns(("result_distance_km", "event_distance"), ("result_time_h", "athlete_time_h"))),
    "mart_time": (R.EVENT_TIME, _columns(("result_time_h", "event_time_h"), ("result_distance_km", "athlete_distance_km"))),
}


def _mart(name: str, fact: DataFrame, events: DataFrame, athletes: DataFrame, days: DataFrame) -> DataFrame:
    event_type, columns = MARTS[name]
    return _star(fact, events, athletes, days, event_type).select(*[F.col(c).alias(n) for c, n in columns])


def mart_distance(fact: DataFrame, events: DataFrame, athletes: DataFrame, days: DataFrame) -> DataFrame:
    """Distance events: the event fixes the distance, athletes differ in time."""
    return _mart("mart_distance", fact, events, athletes, days)


def mart_time(fact: DataFrame, events: DataFrame, athletes: DataFrame, days: DataFrame) -> DataFrame:
    """Time events: the event fixes the duration, athletes differ in distance."""
    return _mart("mart_time", fact, events, athletes, days)


def mart_sql(name: str, namespace: str) -> str:
    """A mart as SQL text over the star's tables in ``namespace``: the definition of its catalog view.

    Ids join as bytes (see :func:`_star`).  Events come last: a key has several of their rows,
    and the athlete's id, a digest in every row, has then given way to the attributes it stands for.
    """
    event_type, columns = MARTS[name]

    def table(of: str, alias: str, *keys: str) -> str:
        # No null joins; bytes that cannot be null are not read a second time to find that out.
        ids = [f"{text} AS {column}" for key in keys for column, text in _bytes_sql(key, "X''").items()]
        return f"(SELECT {', '.join(['*', *ids])} FROM {namespace}.{of} WHERE {' AND '.join(f'{key} IS NOT NULL' for key in keys)}) {alias}"

    def same(key: str, alias: str) -> str:
        return " AND ".join(f"r.{column} = {alias}.{column}" for column in _bytes_sql(key))

    return (
        f"SELECT {', '.join(f'{c} AS {n}' for c, n in columns)} FROM {table('fct_results', 'r', 'event_id', 'athlete_id')}"
        f" JOIN {table('dim_athlete', 'a', 'athlete_id')} ON {same('athlete_id', 'a')}"
        f" JOIN {namespace}.dim_date d ON r.date_id = d.date_id"
        f" JOIN {table('dim_event', 'e', 'event_id')} ON {same('event_id', 'e')} WHERE e.event_type = '{event_type}'"
    )


def _mart_from_silver(silver: DataFrame, events: DataFrame, event_type: str, measure: tuple[str, str],
                      athlete: tuple[str, str]) -> DataFrame:
    """The star-join mart computed with one join instead of three.

    In the star join the athlete and date joins are one-to-one lookups:
    ``athlete_id`` is the hash of exactly the athlete dimension's attributes
    and ``date_id`` is the date itself (``yyyyMMdd``), so those attributes
    are read from silver directly (the inner date join keeps rows with a start
    date).  Only the event dimension can have several rows per key, so only
    it is joined; it is small, and AQE broadcasts it from its runtime size.
    At scale this avoids shuffling the fact rows by athlete.
    """
    r = silver.filter(F.col("event_start_date").isNotNull()).alias("r")
    e = events.filter(F.col("event_type") == event_type).alias("e")
    day = F.col("r.event_start_date")
    return r.join(e, F.col("r.event_id") == F.col("e.event_id")).select(
        F.col("e.event_name").alias("event"),
        F.col("e.event_country_name").alias("event_country"),
        F.col(f"r.{measure[0]}").alias(measure[1]),
        F.col("e.event_type"),
        F.year(day).alias("event_year"),
        F.month(day).alias("event_month"),
        F.date_format(day, "E").alias("event_weekday"),
        day.alias("date"),
        F.col("r.athlete_gender"),
        F.col("r.athlete_country_name").alias("athlete_country"),
        F.col("r.athlete_age"),
        F.col("r.athlete_age_category"),
        F.col(f"r.{athlete[0]}").alias(athlete[1]),
        F.col("r.speed_km_h").alias("athlete_speed_km_h"),
    )


def mart_distance_from_silver(silver: DataFrame, events: DataFrame) -> DataFrame:
    """Same rows as :func:`mart_distance` (see :func:`_mart_from_silver`)."""
    return _mart_from_silver(silver, events, R.EVENT_DISTANCE, ("distance_km", "event_distance"),
                             ("duration_h", "athlete_time_h"))


def mart_time_from_silver(silver: DataFrame, events: DataFrame) -> DataFrame:
    """Same rows as :func:`mart_time` (see :func:`_mart_from_silver`)."""
    return _mart_from_silver(silver, events, R.EVENT_TIME, ("duration_h", "event_time_h"),
                             ("distance_km", "athlete_distance_km"))
