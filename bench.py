"""Benchmark: batch pipeline + mart questions at one scale factor.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default sf0.1) and
prints one JSON line:
``{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}``

Timed steps:
* ``pipeline_bronze`` / ``pipeline_silver`` / ``pipeline_gold``: the layered
  batch pipeline, each layer written as Parquet (lineage cut per layer);
* ``pipeline_marts``: the two star-join marts, materialised once;
* one entry per mart question over the materialised marts (results collected);
* CSV ingest, profiling reports, the star join as a view, an incremental run.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from stridelake.functions.naming import snake_case_columns  # noqa: E402
from stridelake.operators import profile as P  # noqa: E402
from stridelake.operators import star  # noqa: E402
from stridelake.plans import questions as Q  # noqa: E402
from stridelake.plans import silver as silver_plan  # noqa: E402
from stridelake.plans.lake import StoredLake  # noqa: E402
from stridelake.plans import store  # noqa: E402
from stridelake.plans.pipeline import clustered  # noqa: E402
from stridelake.session import build_session, jit_sized_codegen, new_run_dir  # noqa: E402
from stridelake.sources import files, fixture  # noqa: E402
from stridelake.sources.files import write_table  # noqa: E402
from stridelake.streaming.pipeline import run_incremental  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), driver_memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    state = {"root": new_run_dir(spark, "bench"), "tables": {}}

    def write(name: str, df) -> None:
        state["tables"][name] = store.folder("versions/bench", name)
        write_table(df, f"{state['root']}/{state['tables'][name]}")

    def read(name: str):
        return spark.read.parquet(f"{state['root']}/{state['tables'][name]}")

    timings: dict[str, float] = {}

    def timed(name: str, fn) -> None:
        t0 = time.perf_counter()
        fn()
        timings[name] = round(time.perf_counter() - t0, 3)

    replicate = int(os.environ.get("BENCH_REPLICATE", "1"))

    def bronze(src: str = sf_dir, copies: int = 1) -> None:
        raw = fixture.raw_results(spark, src)
        if copies > 1:
            # Scale-up run: every row repeated ``copies`` times (explode, no join).
            raw = raw.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("__copy")
        # The test table is one row group, which one task would project: deal it out here.
        write("raw_marathon", raw.repartition(cpus))
        write("dim_countries", fixture.countries(spark, src))

    def silver() -> None:
        lookup = silver_plan.country_lookup(read("dim_countries"))
        metrics = silver_plan.SilverMetrics()
        with jit_sized_codegen(spark):
            write("marathon_obt", silver_plan.silver_for_write(read("raw_marathon"), lookup, metrics))
        state["sketches"] = metrics.sketches()

    def gold() -> None:
        s = read("marathon_obt")
        write("fct_results", star.fact_results(s))
        write("dim_athlete", star.dim_athlete(s))
        write("dim_event", star.dim_event(s))
        write("dim_date", star.dim_date(s))

    def marts() -> None:
        s, events = read("marathon_obt"), read("dim_event")
        write("mart_distance", clustered(star.mart_distance_from_silver(s, events), "mart_distance", state["sketches"]["mart_distance"]))
        write("mart_time", clustered(star.mart_time_from_silver(s, events), "mart_time", state["sketches"]["mart_time"]))

    def whole(df) -> None:
        """Run a query for all its rows and columns."""
        df.write.format("noop").mode("overwrite").save()

    # Untimed warm-up on smaller test data (enough rows for the JIT to reach
    # its optimising tier): class loading, codegen and
    # JIT compilation happen once per JVM (an executor amortises them over
    # its first tasks), so the timed steps measure steady-state throughput.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", os.path.join(os.path.dirname(sf_dir), "sf0.01"))
    if os.path.isdir(warm_dir):
        bronze(warm_dir)
        silver()
        gold()
        marts()
        state = {"root": new_run_dir(spark, "bench"), "tables": {}}  # the timed run writes a fresh lake

    timed("pipeline_bronze", lambda: bronze(sf_dir, replicate))
    timed("pipeline_silver", silver)
    timed("pipeline_gold", gold)
    timed("pipeline_marts", marts)
    store.publish(spark, state["root"], "batch", "versions/bench", state["tables"])

    lake = StoredLake(spark, state["root"])
    on_time = [
        Q.q1a_events_by_country, Q.q1b_events_by_country_nn, Q.q2a_age_stats, Q.q2b_age_stats_median,
        Q.q3a_longest_24h, Q.q3b_top10_24h,
    ]
    on_distance = [
        Q.q4a_best_100km, Q.q4b_best_100km_by_gender, Q.q5a_gender_gap_50km, Q.q5b_gender_gap_50km,
        Q.q6a_women_50km_by_year, Q.q6b_first_women_50km,
    ]
    for fn in on_time:
        timed(fn.__name__, lambda fn=fn: fn(lake.mart_time).collect())
    for fn in on_distance:
        timed(fn.__name__, lambda fn=fn: fn(lake.mart_distance).collect())

    # What users run besides: CSV ingest with the pinned schema, reports, the
    # star join as a view, and an incremental run.
    landing = new_run_dir(spark, "bench-landing")
    files.write_csv(lake.raw, f"{landing}/raw/a")
    files.write_csv(lake.countries, f"{landing}/countries/a")
    timed("csv_ingest", lambda: write_table(files.read_csv(spark, f"{landing}/raw/a"), f"{landing}/ingested"))
    named = snake_case_columns(lake.raw)
    reports = {
        "null_profile_raw": P.null_profile(lake.raw),
        "null_profile_enriched": P.null_profile(lake.staged()),
        "rule_violations": P.rule_violations(silver_plan.performances(lake.raw)),
        "incomplete_results": P.incomplete_results(silver_plan.incomplete(lake.raw, lake.lookup)),
        "athlete_id_conflicts": P.identity_conflicts(silver_plan.people(named, lake.lookup)),
        "uncastable_speeds": P.uncastable(lake.raw),
        "mart_distance_view": lake.mart_distance_view(),
        "mart_time_view": lake.mart_time_view(),
    }
    for name, df in reports.items():
        timed(name, lambda df=df: whole(df))
    timed("incremental_run", lambda: run_incremental(spark, f"{landing}/raw/*", f"{landing}/countries/*", f"{landing}/lake"))

    sf = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_sec",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf.group(1)) if sf else sf_dir,
                "cpus": cpus,
                "replicate": replicate,
                "warmup": f"pipeline run once untimed on {warm_dir}" if os.path.isdir(warm_dir) else "none",
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
