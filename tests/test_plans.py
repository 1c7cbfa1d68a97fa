"""Plan shape: the physical plans Catalyst picks are the ones we want at scale."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from stridelake.operators import profile as P
from stridelake.plans import questions as Q
from stridelake.plans import silver as silver_plan
from stridelake.plans.pipeline import lake_for
from stridelake.session import new_run_dir
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_silver_lookups_are_broadcast_without_shuffle(spark):
    lake = lake_for(spark, SF_SMALL)
    plan = _plan(silver_plan.silver(lake.raw, lake.lookup))
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan


def test_gate_filter_is_not_inlined_into_parsing(spark):
    """Filters read computed columns; no regex ends up in one."""
    lake = lake_for(spark, SF_SMALL)
    plans = [
        silver_plan.silver_for_write(lake.raw, lake.lookup, silver_plan.SilverMetrics()),
        silver_plan.silver(lake.raw, lake.lookup),
        silver_plan.incomplete(lake.raw, lake.lookup),
    ]
    for line in [x.strip(" :+-") for p in plans for x in _optimized(p).split("\n")]:
        if line.startswith("Filter"):
            assert "regexp" not in line, line


def test_silver_can_be_unioned(spark):
    lake = lake_for(spark, SF_SMALL)
    both = silver_plan.silver(lake.raw, lake.lookup).unionByName(silver_plan.silver(lake.raw, lake.lookup))
    assert both.count() == 2 * lake.silver.count()


def test_reports_join_only_what_they_need(spark):
    lake = lake_for(spark, SF_SMALL)
    q = E._race_queries()
    joins = {name: _optimized(q[name](spark, SF_SMALL)).count("Join ") for name in
             ["rule_violations", "distinct_age_categories", "athlete_identity", "athlete_id_conflicts", "incomplete_results"]}
    assert joins == {"rule_violations": 0, "distinct_age_categories": 0, "athlete_identity": 1, "athlete_id_conflicts": 1, "incomplete_results": 1}
    assert "to_date" not in _optimized(q["rule_violations"](spark, SF_SMALL))
    assert lake.raw is not None


def test_building_a_lake_starts_no_job(spark):
    from stridelake.plans.lake import RaceLake

    spark.sparkContext.setJobGroup("lake-building", "no job expected")
    try:
        lake = RaceLake.from_tables(spark, SF_SMALL)
        for name in ["silver", "fact", "dim_athlete", "dim_event", "dim_date", "mart_distance", "mart_time"]:
            getattr(lake, name)
        lake.enriched()
        # Reading a Parquet footer for the schema runs a job; nothing else may.
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("lake-building")
        stages = [spark.sparkContext.statusTracker().getJobInfo(j).stageIds for j in jobs]
        assert all(len(s) == 1 for s in stages) and len(jobs) <= 4
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def _view(lake):
    from stridelake.operators import star

    return star.mart_distance(lake.fact, lake.dim_event, lake.dim_athlete, lake.dim_date)


def test_mart_view_pushes_event_type_into_dimension_scan(spark):
    plan = _plan(_view(lake_for(spark, SF_SMALL)))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,Distance)" in plan


def test_mart_view_reads_only_needed_columns(spark):
    plan = _plan(Q.q4a_best_100km(_view(lake_for(spark, SF_SMALL))))
    fact_scan = [ln for ln in plan.split("\n") if "ReadSchema" in ln and "result_time_h" in ln]
    assert fact_scan and "result_id" not in plan


def test_questions_scan_the_materialized_mart_with_pushdown(spark):
    answer = Q.q5a_gender_gap_50km(lake_for(spark, SF_SMALL).mart_distance)
    plan = _plan(answer)
    assert all("/mart_distance/" in f for f in answer.inputFiles()) and "Join" not in plan
    assert "EqualTo(event_distance,50.0)" in plan


def test_top_k_has_no_global_sort(spark):
    lake = lake_for(spark, SF_SMALL)
    plan = _plan(Q.q3b_top10_24h(lake.mart_time))
    assert "TakeOrderedAndProject" in plan


def test_null_profile_is_one_aggregate(spark):
    lake = lake_for(spark, SF_SMALL)
    plan = _optimized(P.null_profile(lake.raw))
    assert plan.count("Aggregate") == 1
    assert "Expand" in plan  # unpivot, not a driver-side loop


def test_dimension_distinct_is_two_phase(spark):
    lake = lake_for(spark, SF_SMALL)
    from stridelake.operators import star

    plan = _plan(star.dim_event(lake.silver))
    assert "HashAggregate" in plan and "partial" in plan.lower() or plan.count("HashAggregate") >= 2


def test_layers_are_queryable_as_views(spark):
    lake = lake_for(spark, SF_SMALL)
    names = lake.register_views(prefix="t_")
    assert "t_mart_distance" in names
    n = spark.sql("SELECT count(*) AS n FROM t_mart_distance WHERE event_type = 'Distance'").first().n
    assert n == lake.mart_distance.count()
    by_sql = spark.sql(
        "SELECT d.year, count(*) AS n FROM t_fct_results r JOIN t_dim_date d ON r.date_id = d.date_id GROUP BY d.year"
    )
    assert by_sql.count() > 0


def test_one_join_marts_equal_the_star_join(spark):
    from stridelake.operators import star

    lake = lake_for(spark, SF_SMALL)
    dims = (lake.fact, lake.dim_event, lake.dim_athlete, lake.dim_date)
    pairs = [
        (star.mart_distance(*dims), star.mart_distance_from_silver(lake.silver, lake.dim_event)),
        (star.mart_time(*dims), star.mart_time_from_silver(lake.silver, lake.dim_event)),
    ]
    for view, direct in pairs:
        assert view.schema == direct.schema
        assert view.exceptAll(direct).count() == 0 and direct.exceptAll(view).count() == 0
        assert _plan(direct).count("Join") == 1


def test_layers_are_catalog_tables_with_comments(spark):
    from stridelake.schemas import TABLES

    lake = lake_for(spark, SF_SMALL)
    names = lake.register_tables(prefix="ns_")
    assert "ns_gold.mart_time" in names and "ns_bronze.raw_marathon" in names
    assert spark.catalog.getTable("ns_gold.fct_results").description == TABLES["fct_results"].comment
    assert spark.table("ns_silver.marathon_obt").count() == lake.silver.count()


def test_pipeline_reports_quality_metrics_from_the_write(spark):
    lake = lake_for(spark, SF_SMALL)
    q = lake.quality
    assert q["rows_in"] == lake.raw.count()
    kept = lake.silver.count()
    assert kept <= q["rows_in"] - q["incomplete"]
    assert q["under_min_age"] > 0 and q["over_max_speed"] >= 0


def test_cleaning_is_split_into_jit_sized_stages(spark):
    """In the silver write two observations cut the cleaning into code-generated
    stages; the lookups sit before the first cut, the parsing of performances after it."""
    lake = lake_for(spark, SF_SMALL)
    plan = _optimized(silver_plan.silver_for_write(lake.raw, lake.lookup, silver_plan.SilverMetrics()))
    assert plan.count("CollectMetrics") == 2
    assert plan.index("Join LeftOuter") > plan.rindex("CollectMetrics")  # joins are below (inside) the first stage


def test_an_event_with_races_of_two_types_fans_out(spark):
    """The fixture has events with a Distance and a Time race; the mart must not filter silver by its own type."""
    lake = lake_for(spark, SF_SMALL)
    types = lake.silver.groupBy("event_id").agg(F.countDistinct("event_type").alias("n")).where("n > 1")
    assert types.count() > 0
    own_only = lake.silver.where("event_type = 'Distance' AND event_start_date IS NOT NULL")
    assert lake.mart_distance.count() > own_only.count()


# --- lake roots ----------------------------------------------------------------------


def _built(spark, name, **options):
    from stridelake.plans.pipeline import run_pipeline

    lake = lake_for(spark, SF_SMALL)
    root = new_run_dir(spark, name)
    return root, run_pipeline(spark, lake.raw, lake.countries, root, **options)


def test_tables_are_written_when_first_read(spark):
    from stridelake.plans.pipeline import GrowingLake

    small = lake_for(spark, SF_SMALL)
    lake = GrowingLake(spark, new_run_dir(spark, "test-growing"), small.raw.limit(50), small.countries)
    assert lake.raw.count() == 50 and set(lake.tables) == {"raw_marathon"}
    assert lake.fact.count() == lake.silver.count() and set(lake.tables) == {"raw_marathon", "dim_countries", "marathon_obt", "fct_results"}
    first = dict(lake.tables)
    assert lake.mart_distance.count() == lake.mart_distance_view().count()
    assert "mart_time" not in lake.tables and first.items() <= lake.tables.items()
    assert any(".zstd." in path for path in lake.silver.inputFiles())


def test_marts_left_as_views_are_never_stale(spark):
    from stridelake.plans.pipeline import run_pipeline

    root, lake = _built(spark, "test-stale")
    some = lake.raw.where("`Year of event` > 1997")
    again = run_pipeline(spark, some, lake.countries, root, materialize_marts=False)
    assert "mart_distance" not in again.tables
    assert again.mart_distance.count() == again.mart_distance_view().count() < lake.mart_distance.count()


def test_catalog_follows_the_registered_root(spark):
    _, first = _built(spark, "test-catalog-a")
    _, second = _built(spark, "test-catalog-b", materialize_marts=False)
    first.register_tables(prefix="root_")
    assert spark.table("root_gold.mart_time").count() == first.mart_time.count()
    names = second.register_tables(prefix="root_")
    assert "root_gold.mart_time" in names and spark.catalog.getTable("root_gold.mart_time").tableType == "VIEW"
    assert spark.table("root_gold.mart_time").count() == second.mart_time.count()
    assert second.version in spark.sql("DESCRIBE FORMATTED root_gold.fct_results").where("col_name = 'Location'").first().data_type


def test_batch_and_incremental_lakes_do_not_mix(spark):
    from stridelake.streaming.pipeline import run_incremental

    root, _ = _built(spark, "test-mixed", materialize_marts=False)
    with pytest.raises(ValueError, match="batch"):
        run_incremental(spark, f"{root}/none", f"{root}/none", root)


def test_a_failed_run_leaves_the_published_version(spark):
    from stridelake.plans.lake import StoredLake
    from stridelake.plans.pipeline import run_pipeline

    root, lake = _built(spark, "test-failed", materialize_marts=False)
    broken = lake.raw.withColumn("Event name", F.expr("raise_error('lost')"))
    with pytest.raises(Exception, match="lost"):
        run_pipeline(spark, broken, lake.countries, root)
    assert StoredLake(spark, root).version == lake.version
    assert StoredLake(spark, root).silver.count() == lake.silver.count()


def test_no_lake_is_an_error(spark, tmp_path):
    from stridelake.plans.lake import StoredLake
    from stridelake.plans.store import NoLake

    with pytest.raises(NoLake):
        StoredLake(spark, str(tmp_path))


# --- what grows with the input --------------------------------------------------


def test_line_items_meet_orders_that_met_customers(spark):
    """However large customer is, line items are shuffled by order alone, as whole numbers."""
    from stridelake.sources import fixture

    inner = _optimized(fixture.raw_results(spark, SF_SMALL)).split("Join ")
    assert len(inner) == 3 and "l_orderkey" not in inner[2] and "c_custkey" in inner[2]


def test_a_mart_view_writes_no_fact_and_joins_bytes(spark):
    from stridelake.plans.pipeline import GrowingLake

    small = lake_for(spark, SF_SMALL)
    lake = GrowingLake(spark, new_run_dir(spark, "test-view"), small.raw, small.countries)
    for view, stored in ((lake.mart_distance_view(), small.mart_distance), (lake.mart_time_view(), small.mart_time)):
        joins = [line for line in _optimized(view).split("\n") if "Join " in line]
        assert len(joins) == 3 and not any(" event_id#" in x or "athlete_id#" in x.replace("__athlete_id", "") for x in joins)
        assert view.exceptAll(stored).isEmpty() and stored.exceptAll(view).isEmpty()
    assert "fct_results" not in lake.tables


def test_star_join_tells_all_ids_apart(spark):
    """Digests, other hex digits and other texts; bytes of a digest are another id than the digest."""
    from stridelake.operators import star

    digest = "ab" * 32
    ids = [digest, digest.upper(), "ab", "AB", "é", "", None, digest[:63] + "g", "a" * 32, "61" * 32]
    events = spark.createDataFrame([(x, f"e{i}", "Distance", "C") for i, x in enumerate(ids)], "event_id string, event_name string, event_type string, event_country_name string")
    athletes = spark.createDataFrame([(x, f"g{i}", "D") for i, x in enumerate(ids)], "athlete_id string, athlete_gender string, athlete_country_name string")
    days = spark.sql("SELECT 20240101L AS date_id, DATE'2024-01-01' AS date, 2024 AS year, 1 AS month, 'Mon' AS weekday")
    fact = spark.createDataFrame(
        [(e, a, 30.0, "M", 1.0, 50.0, 10.0, 20240101) for e in ids for a in ids],
        "event_id string, athlete_id string, athlete_age double, athlete_age_category string, result_time_h double, result_distance_km double, result_speed_km_h double, date_id long",
    )
    got = sorted((r.event, r.athlete_gender) for r in star.mart_distance(fact, events, athletes, days).collect())
    known = [i for i, x in enumerate(ids) if x is not None]
    assert got == sorted((f"e{i}", f"g{j}") for i in known for j in known)


def test_keys_of_a_table_stay_in_its_dictionary(spark, tmp_path):
    """40,000 keys of 64 digits that come again 80,000 rows later: written once a key, not twice."""
    from stridelake.sources.files import write_table

    keys = spark.range(0, 160_000, 1, 1).select(F.sha2((F.col("id") % 80_000 / 2).cast("long").cast("string"), 256).alias("k"))
    write_table(keys, str(tmp_path / "keys"))
    written = sum(f.stat().st_size for f in (tmp_path / "keys").glob("*.parquet"))
    assert written < 40_000 * 32 * 1.5


@pytest.mark.parametrize("name", ["quality_filtered", "silver_results"])
def test_whole_cleaning_is_compiled_in_small_methods(spark, name):
    """No generated method is beyond the 8,000 bytes that the JIT compiles, whatever the session's limit."""
    df = E._race_queries()[name](spark, SF_SMALL)
    df.count()
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan()
        stages = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(plan)
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sizes and max(sizes) < 8000, sizes
