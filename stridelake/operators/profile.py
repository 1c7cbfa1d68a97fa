"""Data profiling: counts, null profiles, distributions and rule audits.

Every report is one distributed aggregate (map-side partial aggregation, then
a shuffle of partial results), and results stay DataFrames; nothing is
collected to the driver to be post-processed there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stridelake.functions import dates
from stridelake.functions import rules as R


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("nr_rows"))


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, nulls) for every column with at least one null.

    One pass computes all null counts; ``unpivot`` turns the single wide row
    into rows, so the report never goes through the driver.
    """
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "nulls").filter(F.col("nulls") > 0)


def top_counts(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    """The k most frequent non-null values of ``col`` (ties broken by value)."""
    c = F.col(f"`{col}`")
    return (
        df.filter(c.isNotNull())
        .groupBy(c)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), c.asc())
        .limit(k)
    )


def distinct_count(df: DataFrame, col: str, alias: str) -> DataFrame:
    return df.agg(F.countDistinct(F.col(f"`{col}`")).alias(alias))


def distinct_count_by(df: DataFrame, key: str, col: str, alias: str) -> DataFrame:
    """Distinct values of ``col`` per ``key`` (rows are de-duplicated on
    (key, col) first, so a hot key is collapsed before it is shuffled)."""
    return df.groupBy(F.col(f"`{key}`")).agg(F.countDistinct(F.col(f"`{col}`")).alias(alias)).orderBy(
        F.col(f"`{key}`")
    )


def group_count(df: DataFrame, col: str, alias: str | None = None) -> DataFrame:
    """Row count per value of ``col`` (including null), ordered by value."""
    c = F.col(f"`{col}`")
    key = c.alias(alias) if alias else c
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("count")).orderBy(F.col(f"`{alias or col}`"))


def gender_counts(df: DataFrame, col: str = "Athlete gender") -> DataFrame:
    """Counts of M, F, X and of missing values, in one row."""
    g = F.col(f"`{col}`")
    return df.agg(
        F.count_if(g == "M").alias("male"),
        F.count_if(g == "F").alias("female"),
        F.count_if(g == "X").alias("X"),
        # A missing value is IS NULL; an "= NULL" comparison would never count.
        F.count_if(g.isNull()).alias("nr_null"),
    )


def age_histogram(df: DataFrame, year_col: str = "Year of event", birth_col: str = "Athlete year of birth") -> DataFrame:
    """Athletes per whole age (age truncated to int), ages above 100 left out."""
    age = (F.col(f"`{year_col}`").cast("double") - F.col(f"`{birth_col}`").cast("double")).cast("int")
    return (
        df.select(age.alias("Athlete_Age"))
        .filter(F.col("Athlete_Age").isNotNull() & (F.col("Athlete_Age") <= R.MAX_AGE))
        .groupBy("Athlete_Age")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("Athlete_Age")
    )


def pair_counts(df: DataFrame, first: str, second: str) -> DataFrame:
    return (
        df.groupBy(first, second)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col(second).asc_nulls_first(), F.col(first).asc_nulls_first())
    )


def identity_conflicts(df: DataFrame, id_col: str = "athlete_id") -> DataFrame:
    """Raw IDs carried by more than one gender, country or birth year.

    Several distinct counts in one aggregate: Catalyst expands the rows once
    per distinct column and de-duplicates (id, column, value) map-side, so a
    hot ID is collapsed to its distinct values before the final shuffle.
    """
    return (
        df.groupBy(id_col)
        .agg(
            F.countDistinct("athlete_gender").alias("unique_genders"),
            F.countDistinct("athlete_country_name").alias("unique_countries"),
            F.countDistinct("athlete_year_of_birth").alias("unique_birth_years"),
        )
        .filter((F.col("unique_genders") > 1) | (F.col("unique_countries") > 1) | (F.col("unique_birth_years") > 1))
        .orderBy(F.col("unique_countries").desc(), F.col(id_col))
    )


def rule_violations(df: DataFrame) -> DataFrame:
    """Rows failing each quality rule, counted in a single pass."""
    age = F.col("year_of_event") - F.col("athlete_year_of_birth")
    return df.agg(
        F.count_if(age < R.MIN_AGE).alias("under_15"),
        F.count_if(age > R.MAX_AGE).alias("over_100"),
        F.count_if(F.col("speed_km_h") > R.MAX_SPEED_KMH).alias("over_speed_limit"),
    )


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().orderBy(F.col(col).asc_nulls_first())


def uncastable(df: DataFrame) -> DataFrame:
    """Average-speed texts that are not numbers, with the row context.

    Grouping on the four text columns de-duplicates before the sort.
    """
    speed = F.col("`Athlete average speed`")
    rows = (
        df.filter(speed.try_cast("float").isNull() & speed.isNotNull())
        .groupBy(
            F.col("`Athlete average speed`"),
            F.col("`Event name`"),
            F.col("`Event distance/length`"),
            F.col("`Athlete performance`"),
        )
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            F.col("`Event name`").alias("Event"),
            F.col("`Event distance/length`").alias("time_length"),
            F.col("`Athlete performance`").alias("preformance"),
            F.col("`Athlete average speed`").alias("avg_speed"),
            F.col("`Athlete average speed`").try_cast("float").alias("avg_speed_int"),
        )
    )
    # Ties are broken by the other columns: one speed text may hold every row.
    return rows.orderBy(F.col("avg_speed").desc(), "Event", "time_length", "preformance")


def unit_labels(df: DataFrame, n: int = 40) -> DataFrame:
    """Sample of mile events with a unit label from LIKE patterns.

    Both km and mile events are labelled "km", as in the source report.
    Ordered on every column before the limit so the sample is reproducible.
    """
    goal = F.col("`Event distance/length`")
    unit: Column = (
        F.when(goal.like("%km%"), F.lit("km"))
        .when(goal.like("%mi%"), F.lit("km"))
        .when(goal.like("%h%"), F.lit("h"))
    )
    rows = df.filter(goal.like("%mi%")).select(
        goal.alias("event_goal"),
        F.col("`Athlete performance`").alias("performance"),
        F.col("`Athlete average speed`").alias("avg_speed"),
        unit.alias("Unit"),
    )
    return rows.orderBy(*[F.col(c).asc_nulls_first() for c in rows.columns]).limit(n)


def nonstandard_dates(df: DataFrame, col: str = "event_dates") -> DataFrame:
    """Normalised start-date texts that are not ``dd.MM.yyyy``-long, or missing."""
    start = F.replace(dates.start_text(F.col(col)), F.lit(R.UNKNOWN_PART_TEXT), F.lit(R.UNKNOWN_PART_REPLACEMENT))
    rows = df.select(start.alias("start_date_clean")).distinct()
    return rows.filter((F.length("start_date_clean") != 10) | F.col("start_date_clean").isNull())


def incomplete_results(df: DataFrame) -> DataFrame:
    """The reported columns of the rows that lack a distance, speed or duration."""
    return df.select("event_name", "athlete_average_speed", "duration_h", "distance_km", "speed_km_h", "athlete_id")


def unresolved_countries(df: DataFrame) -> DataFrame:
    """Rows whose event or athlete country did not resolve."""
    unknown = (F.col("event_country_name") == R.UNKNOWN_LABEL) | (F.col("athlete_country_name") == R.UNKNOWN_LABEL)
    return df.filter(unknown).select(
        "event_name", "event_country_code", "event_country_name", "athlete_country", "athlete_country_name"
    )


def stats_with_median(df: DataFrame, col: str, names: dict[str, str]) -> DataFrame:
    """min, max, mean and exact lower median of ``col`` (nulls ignored), in one row.

    The rows are first reduced to a value histogram (one row per distinct
    value, combined map-side), so what is ordered afterwards is bounded by
    the number of distinct values, not rows; ages take a few dozen values.
    For columns of few distinct values only: the histogram is ordered by one task.
    The median is the smallest value whose cumulative count reaches half the
    rows (rank ceil(n/2)), i.e. ``percentile_approx(col, 0.5)`` at full
    accuracy; a sketch that accurate would carry almost every row into the
    single task that merges a global aggregate.
    """
    v = F.col(col)
    hist = df.filter(v.isNotNull()).groupBy(v.alias("v")).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = hist.select(
        "v", "n", F.sum("n").over(upto).alias("cum"), F.sum("n").over(everything).alias("total")
    )
    return ranked.agg(
        F.min("v").alias(names["min"]),
        F.max("v").alias(names["max"]),
        (F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias(names["mean"]),
        F.min(F.when(F.col("cum") >= F.ceil(F.col("total") / 2), F.col("v"))).alias(names["median"]),
    )
