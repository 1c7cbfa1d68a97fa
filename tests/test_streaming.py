"""Streams: exactly-once incremental ingest, and stream = batch for silver."""

from __future__ import annotations

from stridelake.plans.pipeline import lake_for
from stridelake.session import new_run_dir
from stridelake.sources import files
from stridelake.streaming import ingest
from tests.conftest import SF_SMALL


def test_ingest_is_incremental_and_exactly_once(spark):
    lake = lake_for(spark, SF_SMALL)
    run = new_run_dir(spark, "test-ingest")
    half_a, half_b = lake.raw.randomSplit([0.5, 0.5], seed=7)
    files.write_csv(half_a, f"{run}/landing/a")
    q = ingest.ingest_raw(spark, f"{run}/landing/*", f"{run}/raw", f"{run}/_ckpt")
    ingest.run_to_completion(q)
    first = spark.read.parquet(f"{run}/raw").count()
    assert first == half_a.count()

    # Re-running with nothing new appends nothing; a new file is picked up once.
    ingest.run_to_completion(ingest.ingest_raw(spark, f"{run}/landing/*", f"{run}/raw", f"{run}/_ckpt"))
    assert spark.read.parquet(f"{run}/raw").count() == first
    files.write_csv(half_b, f"{run}/landing/b")
    ingest.run_to_completion(ingest.ingest_raw(spark, f"{run}/landing/*", f"{run}/raw", f"{run}/_ckpt"))
    assert spark.read.parquet(f"{run}/raw").count() == lake.raw.count()


def test_silver_stream_equals_batch(spark):
    lake = lake_for(spark, SF_SMALL)
    run = new_run_dir(spark, "test-silver")
    bronze = lake.path("raw_marathon")
    ingest.run_to_completion(ingest.silver_stream(spark, bronze, lake.lookup, f"{run}/silver", f"{run}/_ckpt"))
    streamed = spark.read.parquet(f"{run}/silver").drop("result_id")
    batch = lake.silver.drop("result_id")
    assert streamed.exceptAll(batch).count() == 0
    assert batch.exceptAll(streamed).count() == 0


def test_incremental_pipeline_matches_batch(spark):
    """Two arrivals through the streaming tables give the same layers as one batch run."""
    from stridelake.sources import fixture
    from stridelake.streaming.pipeline import run_incremental

    lake = lake_for(spark, SF_SMALL)
    run = new_run_dir(spark, "test-incremental")
    first, second = lake.raw.randomSplit([0.6, 0.4], seed=11)
    files.write_csv(fixture.countries(spark, SF_SMALL), f"{run}/landing/countries/a")
    files.write_csv(first, f"{run}/landing/raw/a")
    inc = run_incremental(spark, f"{run}/landing/raw/*", f"{run}/landing/countries/*", f"{run}/lake")
    assert inc.raw.count() == first.count()

    files.write_csv(second, f"{run}/landing/raw/b")
    inc = run_incremental(spark, f"{run}/landing/raw/*", f"{run}/landing/countries/*", f"{run}/lake")
    assert inc.countries.count() == lake.countries.count()  # no re-ingest of the same file
    for name in ["silver", "fact"]:
        a, b = getattr(inc, name).drop("result_id"), getattr(lake, name).drop("result_id")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    for name in ["dim_athlete", "dim_event", "dim_date", "mart_distance", "mart_time"]:
        a, b = getattr(inc, name), getattr(lake, name)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_second_arrival_reads_only_new_silver(spark):
    """The dimension streams of a second arrival see its silver rows, not the first one's."""
    from stridelake.sources import fixture
    from stridelake.streaming import pipeline

    lake = lake_for(spark, SF_SMALL)
    run = new_run_dir(spark, "test-arrivals")
    first, second = lake.raw.randomSplit([0.9, 0.1], seed=5)
    files.write_csv(fixture.countries(spark, SF_SMALL), f"{run}/landing/countries/a")
    files.write_csv(first, f"{run}/landing/raw/a")
    args = (spark, f"{run}/landing/raw/*", f"{run}/landing/countries/*", f"{run}/lake")
    before = pipeline.run_incremental(*args)
    old, events = before.silver.count(), before.dim_event.count()
    files.write_csv(second, f"{run}/landing/raw/b")
    after = pipeline.run_incremental(*args)
    assert after.arrivals["dim_event"] == after.arrivals["fct_results"] == after.silver.count() - old > 0
    assert after.dim_event.count() == after.dim_event.distinct().count() >= events


def test_a_country_correction_counts(spark):
    from stridelake.schemas import COUNTRY_SCHEMA
    from stridelake.streaming import pipeline

    run = new_run_dir(spark, "test-correction")
    raw = lake_for(spark, SF_SMALL).raw.limit(20)
    files.write_csv(raw, f"{run}/landing/raw/a")
    args = (spark, f"{run}/landing/raw/*", f"{run}/landing/countries/*", f"{run}/lake")
    for k, name in enumerate(["Aaland", "Sverige"]):
        files.write_csv(spark.createDataFrame([("SWE", name)], COUNTRY_SCHEMA), f"{run}/landing/countries/{k}")
        lake = pipeline.run_incremental(*args)
    assert [r.name for r in lake.lookup.table.collect()] == ["Sverige"]


def test_country_files_that_land_between_batches_count(spark):
    """The static side is looked up again for each micro-batch of one run."""
    from stridelake.plans import silver as silver_plan
    from stridelake.schemas import COUNTRY_SCHEMA

    run = new_run_dir(spark, "test-between")
    raw = lake_for(spark, SF_SMALL).raw.limit(40).repartition(2)
    raw.write.parquet(f"{run}/raw")
    names = iter(["Aaland", "Sverige"])

    def lookup(session):
        row = spark.createDataFrame([("SWE", next(names))], COUNTRY_SCHEMA)
        row.coalesce(1).write.mode("overwrite").parquet(f"{run}/countries")
        return silver_plan.country_lookup(session.read.parquet(f"{run}/countries"))

    seen = []
    plain = silver_plan.silver_for_write

    def spy(rows, table, metrics):
        seen.append([r.name for r in table.table.collect()])
        return plain(rows, table, metrics)

    silver_plan.silver_for_write = spy
    try:
        query = ingest.silver_batches(spark, f"{run}/raw", lookup, f"{run}/silver", f"{run}/quality", f"{run}/_ckpt", max_files=1)
        assert ingest.run_to_completion(query) == 40
    finally:
        silver_plan.silver_for_write = plain
    assert seen == [["Aaland"], ["Sverige"]]


def test_incremental_quality_equals_the_batch_run(spark):
    from stridelake.sources import fixture
    from stridelake.streaming.pipeline import run_incremental

    lake = lake_for(spark, SF_SMALL)
    run = new_run_dir(spark, "test-quality")
    files.write_csv(fixture.countries(spark, SF_SMALL), f"{run}/landing/countries/a")
    for name, half in zip("ab", lake.raw.randomSplit([0.5, 0.5], seed=3)):
        files.write_csv(half, f"{run}/landing/raw/{name}")
        grown = run_incremental(spark, f"{run}/landing/raw/*", f"{run}/landing/countries/*", f"{run}/lake")
        assert grown.arrivals["raw_marathon"] == grown.arrivals["marathon_obt"] == half.count()
    assert grown.quality == lake.quality


def test_dimension_growth_follows_the_arrivals(spark):
    """Two dimensions of very different size take the same arrivals: the same rows are read, shuffled and looked up."""
    from stridelake.operators import star
    from stridelake.streaming import pipeline

    lake = lake_for(spark, SF_SMALL)
    first, later = lake.silver.where("hash(event_name) % 10 <> 0"), lake.silver.where("hash(event_name) % 10 = 0")
    work = {}
    for size, held in (("small", first.limit(50)), ("large", first)):
        run = new_run_dir(spark, f"test-growth-{size}")
        held.write.parquet(f"{run}/silver")
        with pipeline.keyed_state(spark):
            ingest.run_to_completion(pipeline.grow_dimension(spark, f"{run}/silver", lake.silver.schema, star.dim_event, f"{run}/dim", f"{run}/_ckpt"))
            later.coalesce(2).write.mode("append").parquet(f"{run}/silver")
            query = pipeline.grow_dimension(spark, f"{run}/silver", lake.silver.schema, star.dim_event, f"{run}/dim", f"{run}/_ckpt")
            rows = ingest.run_to_completion(query)
        state = [op for p in query.recentProgress for op in p.stateOperators]
        work[size] = (rows, sum(op.numRowsUpdated for op in state))
        assert state[-1].customMetrics.get("rocksdbGetCount") is not None
        want = star.dim_event(held.union(later))
        got = spark.read.parquet(f"{run}/dim")
        assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    assert work["small"] == work["large"] == (later.count(), star.dim_event(later).count())


def test_a_dimension_takes_each_row_once_a_batch(spark):
    """One athlete in one event has nearly all rows: the keyed state sees the distinct rows of a batch, not every row."""
    from pyspark.sql import functions as F
    from stridelake.operators import star
    from stridelake.streaming import pipeline

    hot = spark.range(0, 20_000, 1, 4).select(
        F.when(F.col("id") % 100 > 0, F.sha2(F.lit("hot"), 256)).when(F.col("id") % 300 == 0, F.lit("A" * 64)).when(F.col("id") % 300 == 100, F.lit(None).cast("string")).otherwise(F.lit("")).alias("athlete_id"),
        F.lit("M").alias("athlete_gender"),
        F.when(F.col("id") % 100 > 0, F.lit("N")).alias("athlete_country_name"),
        F.lit(1980.0).alias("athlete_year_of_birth"),
    )
    run = new_run_dir(spark, "test-hot")
    hot.write.parquet(f"{run}/silver")
    columns = star.DIMENSION_INPUTS["dim_athlete"]
    for more in (0, 20_000):  # the second arrival brings nothing new
        if more:
            hot.write.mode("append").parquet(f"{run}/silver")
        query = pipeline.dimension_arrivals(spark, f"{run}/silver", hot.schema, columns, f"{run}/arrived", f"{run}/_ckpt/a")
        assert ingest.run_to_completion(query) == 20_000
        with pipeline.keyed_state(spark):
            schema = spark.read.parquet(f"{run}/arrived").schema
            query = pipeline.grow_dimension(spark, f"{run}/arrived", schema, star.dim_athlete, f"{run}/dim", f"{run}/_ckpt/d")
            assert ingest.run_to_completion(query) == 4
    got, want = spark.read.parquet(f"{run}/dim"), star.dim_athlete(hot)
    assert got.count() == 4 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_an_incremental_run_hands_distinct_rows_to_the_dimensions(spark):
    from stridelake.sources import fixture
    from stridelake.streaming import pipeline

    lake = lake_for(spark, SF_SMALL)
    run = new_run_dir(spark, "test-distinct")
    files.write_csv(fixture.countries(spark, SF_SMALL), f"{run}/landing/countries/a")
    files.write_csv(lake.raw, f"{run}/landing/raw/a")
    grown = pipeline.run_incremental(spark, f"{run}/landing/raw/*", f"{run}/landing/countries/*", f"{run}/lake")
    for name in pipeline.DIMENSIONS:
        arrived = spark.read.parquet(f"{run}/lake/streams/_arrived/{name}")
        assert grown.arrivals[name] == grown.silver.count() > arrived.count() >= getattr(lake, name).count()


def test_keys_of_a_streamed_table_stay_in_its_dictionary(spark):
    """40,000 keys of 64 digits that come again 80,000 rows later: written once a key, as in a batch."""
    from pyspark.sql import functions as F

    run = new_run_dir(spark, "test-keys")
    keys = spark.range(0, 160_000, 1, 1).select(F.sha2((F.col("id") % 80_000 / 2).cast("long").cast("string"), 256).alias("k"))
    keys.write.parquet(f"{run}/in")
    ingest.run_to_completion(ingest.append_to_table(spark.readStream.schema("k string").parquet(f"{run}/in"), f"{run}/out", f"{run}/_ckpt"))
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{run}/out")
    written = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    assert spark.read.parquet(f"{run}/out").count() == 160_000 and written < 40_000 * 32 * 1.5
