"""

Every query reads the driver's tables through the race fixture
(``stridelake.sources.fixture``).  The layered tables (bronze, silver, gold)
are written once per Spark application and test-data folder, each when a query
first reads it, into the shared scratch folder (``spark.checkpoint.dir``),
exactly like the batch pipeline; questions then read the gold tables, and the
transform-level checks read the bronze table.  Streaming and CSV keys write fresh files for every call.
"""

from __future__ import annotations

import threading
import zlib
from collections.abc import Callable
from functools import reduce
from importlib import util

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oracle.sql import oracle_sql as _oracle_sql
from stridelake.functions.naming import snake_case_columns
from stridelake.operators import cleaning as C
from stridelake.operators import profile as P
from stridelake.operators import quantiles, star
from stridelake.plans import questions as Q
from stridelake.plans import silver as silver_plan
from stridelake.plans.lake import StoredLake
from stridelake.plans.pipeline import lake_for
from stridelake.schemas import RAW_SCHEMA, TABLES
from stridelake.session import jit_sized_codegen, new_run_dir
from stridelake.sources import files
from stridelake.streaming import ingest
from stridelake.streaming.pipeline import ingest_countries, run_incremental

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: how much faster men run 50 km than women, year by year."""
    return Q.q5a_gender_gap_50km(lake_for(spark, SMOKE_DIR).mart_distance)


# --- helpers -----------------------------------------------------------------


def _lake(spark: SparkSession, sf_dir: str) -> StoredLake:
    return lake_for(spark, sf_dir)


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snake_case_columns(_lake(spark, sf_dir).raw)


def _csv_copy(spark: SparkSession, sf_dir: str) -> str:
    path = new_run_dir(spark, "csv") + "/raw"
    files.write_csv(_lake(spark, sf_dir).raw, path)
    return path


def _without_result_id(df: DataFrame) -> DataFrame:
    return df.drop("result_id")


# --- sources and sinks ---------------------------------------------------------


def csv_explicit_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_csv(spark, _csv_copy(spark, sf_dir), RAW_SCHEMA)


def csv_inferred_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_csv_inferred(spark, _csv_copy(spark, sf_dir))


def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    inferred = files.read_csv_inferred(spark, _csv_copy(spark, sf_dir))
    return spark.createDataFrame(
        files.schema_report(inferred), "position int, column_name string, data_type string"
    )


def bronze_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = new_run_dir(spark, "bronze-stream")
    files.write_csv(_lake(spark, sf_dir).raw, f"{run}/landing")
    ingest.run_to_completion(ingest.ingest_raw(spark, f"{run}/landing", f"{run}/raw", f"{run}/_checkpoint"))
    return spark.read.parquet(f"{run}/raw")


def countries_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = new_run_dir(spark, "countries-stream")
    files.write_csv(_lake(spark, sf_dir).countries, f"{run}/landing")
    ingest.run_to_completion(ingest_countries(spark, f"{run}/landing", f"{run}/countries", f"{run}/_checkpoint"))
    return spark.read.parquet(f"{run}/countries").drop("ingested_at")


def silver_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark, sf_dir)
    run = new_run_dir(spark, "silver-stream")
    bronze = lake.path("raw_marathon")
    ingest.run_to_completion(ingest.silver_stream(spark, bronze, lake.lookup, f"{run}/silver", f"{run}/_checkpoint"))
    return _without_result_id(spark.read.parquet(f"{run}/silver"))


def fact_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark, sf_dir)
    run = new_run_dir(spark, "fact-stream")
    silver_path = lake.path("marathon_obt")
    query = ingest.fact_stream(spark, silver_path, lake.silver.schema, f"{run}/fact", f"{run}/_checkpoint")
    ingest.run_to_completion(query)
    return _without_result_id(spark.read.parquet(f"{run}/fact"))


# --- catalog names, views, SQL -----------------------------------------------------

_NAMED: dict[tuple[str, str], str] = {}
_NAMED_LOCK = threading.Lock()


def _namespaces(spark: SparkSession, sf_dir: str) -> str:
    """Prefix of the namespaces of an incremental lake of two arrivals: its marts are not stored, so their names are views."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _NAMED_LOCK:
        if key not in _NAMED:
            lake, run = _lake(spark, sf_dir), new_run_dir(spark, "named")
            raw = lake.source("raw_marathon")
            files.write_csv(lake.source("dim_countries"), f"{run}/landing/countries/a")
            for arrival, rows in (("a", raw.where("`Year of event` % 3 > 0")), ("b", raw.where("coalesce(`Year of event` % 3, 0) = 0"))):
                with jit_sized_codegen(spark):
                    files.write_csv(rows, f"{run}/landing/raw/{arrival}", compression="gzip")
                grown = run_incremental(spark, f"{run}/landing/raw/*", f"{run}/landing/countries/*", f"{run}/lake")
            prefix = f"races_{zlib.crc32(key[1].encode()):08x}_"
            grown.register_tables(prefix)
            _NAMED[key] = prefix
        return _NAMED[key]


def from_named_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(f"FROM {_namespaces(spark, sf_dir)}bronze.raw_marathon")


def named_mart(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: spark.table(f"{_namespaces(spark, sf_dir)}gold.{name}")


def named_gender_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(Q.gender_gap_sql(f"{_namespaces(spark, sf_dir)}gold.mart_distance"))


def namespace_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every name in the three namespaces, with its comment and what a query through it counts."""
    prefix = _namespaces(spark, sf_dir)
    rows = []
    for layer in sorted({spec.layer for spec in TABLES.values()}):
        for table in spark.catalog.listTables(f"{prefix}{layer}"):
            if table.isTemporary:
                continue
            named = spark.table(f"{prefix}{layer}.{table.name}")
            rows.append(named.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(layer).alias("layer"), F.lit(table.name).alias("name"), F.lit(table.description).alias("comment"), "n_rows"))
    return reduce(DataFrame.union, rows)


def temp_view_results_per_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session views of the layers, joined by SQL."""
    _lake(spark, sf_dir).register_views("session_")
    return spark.sql(
        "SELECT d.year, e.event_type, count(*) AS n_results FROM session_fct_results r JOIN session_dim_date d ON r.date_id = d.date_id "
        "JOIN (SELECT DISTINCT event_id, event_type FROM session_dim_event) e ON r.event_id = e.event_id GROUP BY d.year, e.event_type"
    )


def speed_quantile_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of speed for each type of race from a sketch a year, merged: are their exact ranks within the stated error?

    The sketches are random within their error, so the answer here is the test of
    the bound (twice the error that 99 % of single answers keep), not the values.
    """
    silver = _lake(spark, sf_dir).silver
    years = quantiles.sketch_by(silver, "speed_km_h", "event_type", "year_of_event")
    ranks = {f"p{p:02d}": p / 100 for p in (5, 25, 50, 75, 95)}
    found = quantiles.at(quantiles.merged(years, "event_type"), ranks)
    joined = silver.select("event_type", "speed_km_h").join(found, "event_type")
    below = [F.count_if(F.col("speed_km_h") < F.col(p)).alias(f"{p}_below") for p in ranks]
    upto = [F.count_if(F.col("speed_km_h") <= F.col(p)).alias(f"{p}_upto") for p in ranks]
    counted = joined.groupBy("event_type").agg(F.count("speed_km_h").alias("n_results"), *below, *upto)
    slack = 2 * quantiles.rank_error() * F.col("n_results") + 1
    return counted.select("event_type", "n_results", *[((F.col(f"{p}_below") <= r * F.col("n_results") + slack) & (F.col(f"{p}_upto") >= r * F.col("n_results") - slack)).alias(f"{p}_within") for p, r in ranks.items()])


# --- projections, predicates, joins --------------------------------------------


def snake_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(spark, sf_dir)


def quality_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.quality_gate(_lake(spark, sf_dir).staged())


def _staged(fn: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(_lake(spark, sf_dir).staged())


def incomplete_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark, sf_dir)
    return P.incomplete_results(silver_plan.incomplete(lake.raw, lake.lookup))


def country_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark, sf_dir)
    return C.add_athlete_country(_named(spark, sf_dir), lake.lookup).select("athlete_country", "athlete_country_name")


def country_lookup_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark, sf_dir)
    df = (
        _named(spark, sf_dir)
        .transform(C.parse_event_names)
        .transform(C.add_event_country, lake.lookup)
        .transform(C.add_athlete_country, lake.lookup)
    )
    return df.select("event_country_code", "event_country_name", "athlete_country", "athlete_country_name")


def global_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark, sf_dir)
    df = (
        _named(spark, sf_dir)
        .transform(C.parse_event_names)
        .transform(C.add_event_country, lake.lookup)
        .transform(C.mark_global_events)
    )
    return df.select("event_name", "event_country_code", "event_country_name")


# --- domain transforms -----------------------------------------------------------


def event_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = C.normalize_event_dates(_named(spark, sf_dir))
    return df.select("event_dates", "is_estimated_date", "event_start_date", "event_end_date")


def event_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.parse_event_names(_named(spark, sf_dir)).select("event_name", "event_country_code", "event_name_cleaned")


def performance_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = _named(spark, sf_dir).select(
        "event_name",
        "event_distance_length",
        "athlete_performance",
        F.col("event_distance_length").alias("__distance"),
        F.col("athlete_performance").alias("__performance"),
    )
    df = C.add_performance_metrics(named, "__distance", "__performance")
    return df.select(
        "event_name", "event_distance_length", "athlete_performance", "event_type", "duration_h", "distance_km", "speed_km_h"
    )


def gender_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _named(spark, sf_dir).select(F.col("athlete_gender").alias("athlete_gender_raw"), "athlete_gender")
    return C.normalize_gender(raw)


def age_category_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _named(spark, sf_dir).select(
        F.col("athlete_age_category").alias("athlete_age_category_raw"), "athlete_age_category"
    )
    return C.normalize_age_category(raw)


def athlete_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark, sf_dir)
    df = silver_plan.people(_named(spark, sf_dir), lake.lookup).transform(C.add_athlete_identity)
    return df.select("athlete_id", "athlete_gender", "athlete_country_name", "athlete_year_of_birth")


def event_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lake(spark, sf_dir).silver.select("event_id", "event_name", "year_of_event")


def result_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lake(spark, sf_dir).silver.agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("result_id").alias("n_distinct_result_ids")
    )


def silver_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver derived from the stored bronze within this plan (not the stored copy)."""
    lake = _lake(spark, sf_dir)
    return _without_result_id(silver_plan.silver_for_write(lake.raw, lake.lookup, "silver_results"))


# --- profiling ----------------------------------------------------------------------


def _simple(fn: Callable[[DataFrame], DataFrame], layer: str = "raw") -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        lake = _lake(spark, sf_dir)
        source = {
            "raw": lambda: lake.raw,
            "named": lambda: snake_case_columns(lake.raw),
            "enriched": lambda: lake.enriched(),
            "people": lambda: silver_plan.people(snake_case_columns(lake.raw), lake.lookup),
            "performances": lambda: silver_plan.performances(lake.raw),
            "located": lambda: silver_plan.located(lake.raw, lake.lookup),
            "silver": lambda: lake.silver,
            "mart_distance": lambda: lake.mart_distance,
            "mart_time": lambda: lake.mart_time,
            "dim_date": lambda: lake.dim_date,
            "dim_event": lambda: lake.dim_event,
        }[layer]()
        return fn(source)

    run.__name__ = getattr(fn, "__name__", "query")
    return run


def _gold(attr: str, drop_result_id: bool = False) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = getattr(_lake(spark, sf_dir), attr)
        return _without_result_id(df) if drop_result_id else df

    return run


def _smoke(fn) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        lake = _lake(spark, sf_dir)
        return fn(lake.fact, lake.dim_event, lake.dim_athlete, lake.dim_date)

    return run


def _llm():
    """The training-data operators, where their subpackage is installed."""
    try:
        from stridelake.llm import registry
    except ModuleNotFoundError as missing:
        if missing.name not in ("stridelake.llm", "stridelake.llm.registry"):
            raise  # the subpackage is there and something it needs is not
        return None
    except ImportError:
        if util.find_spec("stridelake.llm.registry"):
            raise
        return None  # an empty folder of that name
    return registry


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    llm = _llm()
    more = llm.queries() | ({"pipeline": _pipeline} if util.find_spec("corpus_pipeline") else {}) if llm else {}
    return _race_queries() | more


def _race_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # Sources and sinks.
        "csv_explicit_schema": csv_explicit_schema,
        "csv_inferred_roundtrip": csv_inferred_roundtrip,
        "schema_report": schema_report,
        "bronze_stream_ingest": bronze_stream_ingest,
        "countries_stream_ingest": countries_stream_ingest,
        "silver_stream": silver_stream,
        "fact_stream": fact_stream,
        # Catalog names, views, SQL.
        "from_named_table": from_named_table,
        "named_mart_distance": named_mart("mart_distance"),
        "named_mart_time": named_mart("mart_time"),
        "named_gender_gap": named_gender_gap,
        "namespace_row_counts": namespace_row_counts,
        "temp_view_results_per_year": temp_view_results_per_year,
        "speed_quantile_bounds": speed_quantile_bounds,
        # Projections and predicates.
        "snake_case_columns": snake_case,
        "quality_filtered": quality_filtered,
        "incomplete_results": incomplete_results,
        "unit_labels": _simple(P.unit_labels),
        "uncastable_speeds": _simple(P.uncastable),
        "nonstandard_dates": _simple(P.nonstandard_dates, "named"),
        # Joins.
        "country_lookup": country_lookup,
        "country_lookup_twice": country_lookup_twice,
        "global_events": global_events,
        "unresolved_countries": _simple(P.unresolved_countries, "located"),
        # Aggregations.
        "row_count": _simple(P.row_count),
        "null_profile_raw": _simple(P.null_profile),
        "null_profile_enriched": _staged(P.null_profile),
        "null_profile_silver": _simple(P.null_profile, "silver"),
        "top_countries": _simple(lambda df: P.top_counts(df, "Athlete country", 10)),
        "distinct_events": _simple(lambda df: P.distinct_count(df, "Event name", "nr_events")),
        "events_per_year": _simple(lambda df: P.distinct_count_by(df, "Year of event", "Event name", "nr_events")),
        "count_by_age_category": _simple(lambda df: P.group_count(df, "Athlete age category", "Category")),
        "count_by_event_date": _simple(lambda df: P.group_count(df, "Event dates")),
        "gender_counts": _simple(P.gender_counts),
        "age_histogram": _simple(P.age_histogram),
        "count_by_year_birth": _simple(lambda df: P.pair_counts(df, "year_of_event", "athlete_year_of_birth"), "named"),
        "athlete_id_conflicts": _simple(P.identity_conflicts, "people"),
        "rule_violations": _simple(P.rule_violations, "performances"),
        "distinct_clubs": _simple(lambda df: P.distinct_values(df, "athlete_club"), "named"),
        "distinct_age_categories": _simple(lambda df: P.distinct_values(C.normalize_age_category(df), "athlete_age_category"), "named"),
        # Domain transforms.
        "event_dates": event_dates,
        "event_names": event_names,
        "performance_metrics": performance_metrics,
        "gender_clean": gender_clean,
        "age_category_clean": age_category_clean,
        "athlete_identity": athlete_identity,
        "event_keys": event_keys,
        "result_keys": result_keys,
        "silver_results": silver_results,
        # Gold star schema.
        "dim_athlete": _gold("dim_athlete"),
        "dim_event": _gold("dim_event"),
        "dim_date": _gold("dim_date"),
        "fct_results": _gold("fact", drop_result_id=True),
        "mart_distance": _gold("mart_distance"),
        "mart_time": _gold("mart_time"),
        "mart_distance_view": lambda spark, sf_dir: _lake(spark, sf_dir).mart_distance_view(),
        "mart_time_view": lambda spark, sf_dir: _lake(spark, sf_dir).mart_time_view(),
        "dim_event_key_violations": _simple(lambda df: star.key_violations(df, "event_id"), "dim_event"),
        # Mart questions.
        "q1a_events_by_country": _simple(Q.q1a_events_by_country, "mart_time"),
        "q1b_events_by_country_nn": _simple(Q.q1b_events_by_country_nn, "mart_time"),
        "q2a_age_stats": _simple(Q.q2a_age_stats, "mart_time"),
        "q2b_age_stats_median": _simple(Q.q2b_age_stats_median, "mart_time"),
        "q3a_longest_24h": _simple(Q.q3a_longest_24h, "mart_time"),
        "q3b_top10_24h": _simple(Q.q3b_top10_24h, "mart_time"),
        "q4a_best_100km": _simple(Q.q4a_best_100km, "mart_distance"),
        "q4b_best_100km_by_gender": _simple(Q.q4b_best_100km_by_gender, "mart_distance"),
        "q5a_gender_gap_50km": _simple(Q.q5a_gender_gap_50km, "mart_distance"),
        "q5b_gender_gap_50km": _simple(Q.q5b_gender_gap_50km, "mart_distance"),
        "q6a_women_50km_by_year": _simple(Q.q6a_women_50km_by_year, "mart_distance"),
        "q6b_first_women_50km": _simple(Q.q6b_first_women_50km, "mart_distance"),
        "smoke_mart_time": _smoke(Q.smoke_mart_time),
        "smoke_mart_distance": _smoke(Q.smoke_mart_distance),
        "preview_dim_date": _simple(Q.preview_dim_date, "dim_date"),
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per key."""
    llm = _llm()
    return _oracle_sql() | (llm.oracle_sql() if llm else {})
