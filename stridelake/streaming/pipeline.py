"""Incremental pipeline: every stored table is append-only and fed by a stream.

Each call processes whatever arrived in the landing folders since the last
call (``availableNow`` + checkpoints under ``<root>/_checkpoints``): bronze,
silver and the fact as streaming tables, the dimensions as streams of the rows
they do not hold yet (keyed state) out of the distinct ones that arrived.  The marts are views, so no call reads all of silver.
Re-running after a failure resumes from the checkpoints: no file is ingested
twice and none is skipped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.operators import star
from stridelake.plans import silver as silver_plan
from stridelake.plans import store
from stridelake.plans.lake import StoredLake
from stridelake.schemas import COUNTRY_SCHEMA
from stridelake.session import jit_sized_codegen, settings
from stridelake.sources.files import stream_csv, write_table
from stridelake.streaming import ingest

DIMENSIONS = {"dim_athlete": star.dim_athlete, "dim_event": star.dim_event, "dim_date": star.dim_date}


def ingest_countries(spark: SparkSession, landing: str, out: str, checkpoint: str):
    """Bronze countries: append-only, each row with its ingest time (a later name of a code is a correction)."""
    rows = stream_csv(spark, landing, COUNTRY_SCHEMA).withColumn("ingested_at", F.current_timestamp())
    return ingest.append_to_table(rows, out, checkpoint, "bronze_countries")


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Within the block, queries keep their state in RocksDB (on disk, a change log for each batch), not in the executors' heaps."""
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    with settings(spark, wanted):
        yield


def grow_dimension(spark: SparkSession, silver_path: str, silver_schema, derive: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, name: str | None = None):
    """Append the dimension rows of newly arrived silver rows that the dimension lacks.

    The dimension's own definition (a distinct) runs as a stream: its keyed state
    remembers the rows it has seen, so a batch looks up what arrived and neither
    reads nor shuffles what the dimension holds already.
    """
    stream = spark.readStream.schema(silver_schema).parquet(silver_path)
    return ingest.append_to_table(derive(stream), out, checkpoint, name)


def dimension_arrivals(spark: SparkSession, silver_path: str, silver_schema, columns: list[str], out: str, checkpoint: str, name: str | None = None):
    """The distinct values of ``columns`` in each micro-batch of silver, in a folder ``batch=<id>`` below ``out``.

    A stream's own distinct shuffles every row to the state of its key.  A batch's
    distinct combines before the shuffle: a row that a task meets many times leaves it
    once, so the state of a dimension that reads ``out`` looks up each row once a batch.
    A batch that is repeated after a failure replaces its folder.
    """
    ids = [c for c in ("event_id", "athlete_id") if c in columns]

    def each(rows: DataFrame, batch_id: int) -> None:
        write_table(star.distinct_by_bytes(rows, *ids), f"{out}/batch={batch_id}")

    stream = spark.readStream.schema(silver_schema).parquet(silver_path).select(*columns)
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.queryName(f"{name}_arrivals") if name else writer).trigger(availableNow=True).start()


def quality(spark: SparkSession, path: str) -> dict | None:
    """Metrics of all silver batches, added up."""
    rows = spark.read.parquet(path).drop("batch")
    return rows.agg(*[F.sum(c).alias(c) for c in rows.columns]).first().asDict()


def run_incremental(spark: SparkSession, raw_landing: str, countries_landing: str, root: str) -> StoredLake:
    """Process what arrived; the lake, with ``quality`` (of all rows so far, as after a batch run)
    and ``arrivals`` (rows that each stream took in during this call)."""
    store.expect_kind(spark, root, "incremental")
    root = root.rstrip("/")
    names = ["raw_marathon", "dim_countries", "marathon_obt", "fct_results", *DIMENSIONS]
    tables = {name: store.folder("streams", name) for name in names}
    path = {name: f"{root}/{folder}" for name, folder in tables.items()}
    checkpoint = {name: f"{root}/_checkpoints/{name}" for name in names}
    metrics = f"{root}/streams/_quality"

    # Bronze: both landing folders are append-only streaming tables.
    started = {
        "raw_marathon": ingest.ingest_raw(spark, raw_landing, path["raw_marathon"], checkpoint["raw_marathon"]),
        "dim_countries": ingest_countries(spark, countries_landing, path["dim_countries"], checkpoint["dim_countries"]),
    }
    arrivals = {name: ingest.run_to_completion(query) for name, query in started.items()}

    # Silver: new bronze rows joined to the country table as it is at each batch.
    def lookup(session: SparkSession):
        return silver_plan.country_lookup(session.read.parquet(path["dim_countries"]))

    with jit_sized_codegen(spark):
        query = ingest.silver_batches(spark, path["raw_marathon"], lookup, path["marathon_obt"], metrics, checkpoint["marathon_obt"])
        arrivals["marathon_obt"] = ingest.run_to_completion(query)

    # Gold: the fact is a projection of new silver rows, dimensions grow by the distinct ones; they run side by side.
    schema = spark.read.parquet(path["marathon_obt"]).schema
    arrived = {name: f"{root}/streams/_arrived/{name}" for name in DIMENSIONS}
    started = {"fct_results": ingest.fact_stream(spark, path["marathon_obt"], schema, path["fct_results"], checkpoint["fct_results"])}
    for name in DIMENSIONS:
        columns = star.DIMENSION_INPUTS[name]
        started[name] = dimension_arrivals(spark, path["marathon_obt"], schema, columns, arrived[name], f"{root}/_checkpoints/_arrived/{name}", name)
    arrivals |= {name: ingest.run_to_completion(query) for name, query in started.items()}
    with keyed_state(spark):
        grown = [
            grow_dimension(spark, arrived[name], spark.read.parquet(arrived[name]).schema, derive, path[name], checkpoint[name], name)
            for name, derive in DIMENSIONS.items()
        ]
        for query in grown:
            ingest.run_to_completion(query)
    store.publish(spark, root, "incremental", "streams", tables)
    lake = StoredLake(spark, root)
    lake.quality, lake.arrivals = quality(spark, metrics), arrivals
    return lake
