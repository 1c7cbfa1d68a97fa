"""Names, views and SQL over a lake; sketches and layouts that use them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from stridelake.operators import quantiles, star
from stridelake.plans import questions as Q
from stridelake.plans import silver as silver_plan
from stridelake.plans.pipeline import clustered, lake_for
from stridelake.session import new_run_dir
from tests.conftest import SF_SMALL
from tests.test_plans import _optimized, _plan


@pytest.fixture(scope="module")
def names(spark):
    return E._namespaces(spark, SF_SMALL)


def test_marts_of_an_incremental_lake_are_views_by_name(spark, names):
    lake = lake_for(spark, SF_SMALL)
    for name in ("mart_distance", "mart_time"):
        assert spark.catalog.getTable(f"{names}gold.{name}").tableType == "VIEW"
        named = spark.table(f"{names}gold.{name}")
        assert named.schema == getattr(lake, name).schema
        stored = getattr(lake, name)
        assert named.exceptAll(stored).count() == 0 and stored.exceptAll(named).count() == 0
    definition = spark.sql(f"SHOW CREATE TABLE {names}gold.mart_distance").first()[0]
    assert "JOIN" in definition and "fct_results" in definition


def test_named_tables_hide_technical_columns(spark, names):
    lake = lake_for(spark, SF_SMALL)
    assert spark.table(f"{names}silver.marathon_obt").columns == lake.silver.columns
    assert spark.table(f"{names}bronze.dim_countries").columns == lake.countries.columns
    assert spark.table(f"{names}silver.marathon_obt").count() == lake.silver.count()


def test_views_follow_their_tables(spark):
    """A view is a definition: rows that a table gains show in it without another registration."""
    lake = lake_for(spark, SF_SMALL)
    prefix = "grow_"
    lake.register_tables(prefix)
    lake._forget(f"{prefix}gold.mart_time")
    lake._create_view(f"{prefix}gold.mart_time", "the star join", star.mart_sql("mart_time", f"{prefix}gold"))
    before = spark.table(f"{prefix}gold.mart_time").count()
    lake._forget(f"{prefix}gold.fct_results")
    path = new_run_dir(spark, "grown") + "/fact"
    lake.fact.union(lake.fact).write.parquet(path)
    spark.catalog.createTable(f"{prefix}gold.fct_results", path=path, source="parquet")
    assert spark.table(f"{prefix}gold.mart_time").count() == 2 * before


def test_filtered_aggregates_and_lateral_aliases(spark):
    lake = lake_for(spark, SF_SMALL)
    answer = Q.q5a_gender_gap_50km(lake.mart_distance)
    plan = answer._jdf.queryExecution().toString()
    assert "FILTER (WHERE" in plan.upper() or "filter (where" in plan.lower()
    assert "lateralAliasReference(avg_male_speed)" in plan or "avg_male_speed" in answer.columns
    assert "CASE" not in answer._jdf.queryExecution().analyzed().toString()


# --- the barrier ----------------------------------------------------------------------


def test_filters_on_raw_columns_pass_the_gate(spark):
    lake = lake_for(spark, SF_SMALL)
    for df in (silver_plan.silver(lake.raw, lake.lookup), silver_plan.incomplete(lake.raw, lake.lookup)):
        plan = _plan(df.filter("year_of_event = 1995"))
        assert "EqualTo(`Year of event`,1995)" in plan
    some = silver_plan.silver(lake.raw, lake.lookup).filter("year_of_event = 1995").drop("result_id")
    want = lake.silver.filter("year_of_event = 1995").drop("result_id")
    assert some.count() > 0 and some.exceptAll(want).count() == 0 and want.exceptAll(some).count() == 0


def test_the_gate_prunes_columns_and_parses_once(spark):
    lake = lake_for(spark, SF_SMALL)
    plan = _plan(silver_plan.silver(lake.raw, lake.lookup).select("year_of_event", "speed_km_h"))
    scan = next(line for line in plan.split("\n") if "ReadSchema" in line and "Year of event" in line)
    assert "Event dates" not in scan and "Athlete club" not in scan
    whole = _optimized(silver_plan.silver(lake.raw, lake.lookup))
    once = _optimized(silver_plan.enriched(lake.raw, lake.lookup))
    assert whole.count("regexp") <= once.count("regexp") + 1  # the event key's name


def test_ids_of_stored_rows_are_stable_and_unique(spark):
    lake = lake_for(spark, SF_SMALL)
    first, second = (silver_plan.silver(lake.raw, lake.lookup) for _ in range(2))
    ids = first.select("result_id")
    assert ids.distinct().count() == first.count() == lake.silver.count()
    assert ids.exceptAll(second.select("result_id")).count() == 0
    assert ids.filter(~F.col("result_id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")).count() == 0
    twice = lake.raw.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2)))).drop("n")  # a stored row stands for two
    assert silver_plan.silver(twice, lake.lookup).select("result_id").distinct().count() == 2 * first.count()


def test_staged_profile_is_two_stages(spark):
    lake = lake_for(spark, SF_SMALL)
    assert _optimized(lake.staged()).count("CollectMetrics") == 1
    assert lake.staged().exceptAll(lake.enriched()).count() == 0


# --- sketches and layouts ---------------------------------------------------------------


@pytest.mark.parametrize("k", [50, 200])
def test_merged_sketches_keep_the_rank_error(spark, k):
    n = 40_000
    rows = spark.range(n, numPartitions=6).select((F.col("id") * 7919 % n).cast("double").alias("v"), (F.col("id") % 9).alias("day"))
    rows = rows.union(spark.createDataFrame([(None, 1)], "v double, day long"))
    days = quantiles.sketch_by(rows, "v", "day", k=k)
    ranks = {f"p{i}": i / 20 for i in range(1, 20)}
    answer = quantiles.at(quantiles.merged(days, k=k), ranks).first()
    assert answer["n"] == n
    errors = [abs(answer[name] / n - rank) for name, rank in ranks.items()]  # the values are their own ranks
    assert max(errors) <= 2 * quantiles.rank_error(k) + 1 / n


def test_no_values_have_no_quantiles(spark):
    rows = spark.createDataFrame([("a", None), ("a", None), ("b", 3.0)], "k string, v double")
    got = {r["k"]: (r["n"], r["p"]) for r in quantiles.at(quantiles.sketch_by(rows, "v", "k"), {"p": 0.5}).collect()}
    assert got == {"a": (0, None), "b": (1, 3.0)}
    empty = quantiles.sketch_by(rows.where("k = 'a'"), "v").first()["sketch"]
    assert quantiles.cuts(spark, bytes(empty), 8) == []


def test_layout_spreads_a_hot_value_and_keeps_ranges(spark):
    rows = spark.range(20_000, numPartitions=4).select(F.when(F.col("id") % 3 == 0, 50.0).otherwise(F.rand(1) * 100).alias("km"), F.col("id").alias("n"))
    rows = rows.union(spark.createDataFrame([(None, -1)], "km double, n long"))
    stored = bytes(quantiles.sketch_by(rows, "km").first()["sketch"])
    points = quantiles.cuts(spark, stored, 8)
    assert len(points) == 7 and points == sorted(points) and points.count(50.0) >= 2
    for partitions in (8, 16):
        out = quantiles.laid_out(rows, "km", points, F.xxhash64("n"), partitions)
        assert out.rdd.getNumPartitions() == partitions
        sizes = out.where("km IS NOT NULL").groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.min("km").alias("low"), F.max("km").alias("high")).orderBy("p").collect()
        assert max(r["n"] for r in sizes) < 2.2 * 20_000 / partitions
        step = partitions // 8
        highs = [max(r["high"] for r in sizes if r["p"] // step == i) for i in range(8)]
        lows = [min(r["low"] for r in sizes if r["p"] // step == i) for i in range(8)]
        assert all(high <= low for high, low in zip(highs, lows[1:]))
        assert out.exceptAll(rows).count() == 0 and out.count() == rows.count()


def test_marts_are_laid_out_without_a_second_run_of_the_join(spark):
    """No sampling: building the layout starts no job over silver, and the plan has one exchange by part."""
    lake = lake_for(spark, SF_SMALL)
    metrics = silver_plan.SilverMetrics()
    silver_plan.silver_for_write(lake.raw, lake.lookup, metrics).write.format("noop").mode("overwrite").save()
    mart = star.mart_distance_from_silver(lake.silver, lake.dim_event)
    out = clustered(mart, "mart_distance", metrics.sketches()["mart_distance"])
    plan = _plan(out)
    assert "rangepartitioning" not in plan.lower() and plan.count("Scan parquet") <= 2
    assert out.exceptAll(lake.mart_distance).count() == 0 and out.count() == lake.mart_distance.count()


# --- what the names cost on disk --------------------------------------------------------------


def test_named_marts_deal_ids_as_bytes(spark, names):
    """No exchange of a mart's view carries an id as 64 hex digits, and the athletes' ids do not go on to the events."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = {key: spark.conf.get(key) for key in keys}
    for name in ("mart_distance", "mart_time"):
        try:
            spark.conf.set(keys[0], "-1")
            spark.conf.set(keys[1], "false")
            plan = spark.table(f"{names}gold.{name}")._jdf.queryExecution().executedPlan()
            lines = plan.toString().split("\n")
        finally:
            for key, value in before.items():
                spark.conf.set(key, value)
        dealt = [line for line in lines if "Exchange hashpartitioning" in line]
        assert sum("_id_bytes" in line for line in dealt) == 4
        assert not [line for line in dealt if "(event_id" in line or "(athlete_id" in line]
        joins = [line for line in lines if "SortMergeJoin" in line]
        assert "event_id_bytes" in joins[0] and not [line for line in joins[1:] if "event_id_bytes" in line]


def test_named_marts_compare_ids_as_texts(spark):
    """Digests, texts that only look like one, other texts and nulls meet as the texts they are, as often as they come."""
    ids = ["a" * 64, "A" * 64, "aA" * 32, "\xaa" * 32, "x", "", None, "0", "é"]
    prefix = "odd_ids_"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}gold")
    events = [(k, f"e{i}", "Distance", "c") for i, k in enumerate(ids)] + [("x", "again", "Distance", "c"), ("x", "other", "Time", "c")]
    frames = {
        "fct_results": spark.createDataFrame(
            [(e, a, 30.0, "M", 1.0, 50.0, 10.0, 20240101) for e in ids for a in ids],
            "event_id string, athlete_id string, athlete_age double, athlete_age_category string, result_time_h double, result_distance_km double, result_speed_km_h double, date_id long",
        ),
        "dim_event": spark.createDataFrame(events, "event_id string, event_name string, event_type string, event_country_name string"),
        "dim_athlete": spark.createDataFrame([(k, f"g{i}", "n") for i, k in enumerate(ids)], "athlete_id string, athlete_gender string, athlete_country_name string"),
        "dim_date": spark.sql("SELECT 20240101L AS date_id, DATE'2024-01-01' AS date, 2024 AS year, 1 AS month, 'Mon' AS weekday"),
    }
    for name, frame in frames.items():
        frame.write.mode("overwrite").saveAsTable(f"{prefix}gold.{name}")
    got = sorted((r.event, r.athlete_gender) for r in spark.sql(star.mart_sql("mart_distance", f"{prefix}gold")).collect())
    known = [i for i, x in enumerate(ids) if x is not None]
    assert got == sorted((e, f"g{j}") for i in known for j in known for e in ([f"e{i}", "again"] if ids[i] == "x" else [f"e{i}"]))
    for name in frames:
        spark.sql(f"DROP TABLE {prefix}gold.{name}")
    spark.sql(f"DROP DATABASE {prefix}gold")


def test_names_write_no_second_bronze(spark):
    """The landing files are written from the source, not from a stored copy of it."""
    folder = f"{SF_SMALL}/."  # a lake of its own
    prefix = E._namespaces(spark, folder)
    lake = lake_for(spark, folder)
    assert "raw_marathon" not in lake.tables
    assert spark.table(f"{prefix}bronze.raw_marathon").exceptAll(lake_for(spark, SF_SMALL).raw).count() == 0
    assert spark.table(f"{prefix}bronze.raw_marathon").count() == lake_for(spark, SF_SMALL).raw.count()
    assert lake.source("raw_marathon").exceptAll(lake.raw).count() == 0 and "raw_marathon" in lake.tables
