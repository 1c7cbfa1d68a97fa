"""Structured Streaming versions of the three streaming tables.

Every stream is a stateless append: file source -> row maps (plus a
stream-static lookup join) -> Parquet file sink with a checkpoint, so each
input file is processed exactly once and a restarted query resumes where the
checkpoint says.  ``availableNow`` processes everything present and stops,
which gives incremental batch runs; drop the trigger for a continuous job.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from stridelake.operators import star
from stridelake.operators.lookup import CodeLookup
from stridelake.plans import silver as silver_plan
from stridelake.schemas import RAW_SCHEMA
from stridelake.session import settings
from stridelake.sources.files import PARQUET_OPTIONS, TABLE_COMPRESSION, stream_csv, write_table


def append_to_table(
    df: DataFrame, path: str, checkpoint: str, name: str | None = None, available_now: bool = True
) -> StreamingQuery:
    """Append a streaming DataFrame to a Parquet table (exactly-once via checkpoint)."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).option("compression", TABLE_COMPRESSION)
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    with settings(df.sparkSession, PARQUET_OPTIONS):  # the file sink takes Parquet's own options from the session only, when it starts
        return writer.start(path)


def run_to_completion(query: StreamingQuery, timeout_s: float | None = None) -> int:
    """Wait for the end; the rows that the query took in, from its progress reports."""
    query.awaitTermination(timeout_s)
    if query.exception() is not None:
        raise query.exception()
    return sum(p.numInputRows for p in query.recentProgress)


def ingest_raw(
    spark: SparkSession, landing: str, out: str, checkpoint: str, schema: StructType = RAW_SCHEMA
) -> StreamingQuery:
    """Bronze: CSV landing folder -> raw table, schema pinned."""
    return append_to_table(stream_csv(spark, landing, schema), out, checkpoint, "bronze_raw")


def silver_stream(
    spark: SparkSession, bronze_path: str, lookup: CodeLookup, out: str, checkpoint: str
) -> StreamingQuery:
    """Silver: stream of the bronze table joined to the static country table.

    The files of the country table are those of the time when ``lookup`` was made,
    for every micro-batch; :func:`silver_batches` looks anew for each.  Rows already
    written are never revisited if it changes later (a full refresh means a new
    checkpoint and output folder).
    """
    raw = spark.readStream.schema(RAW_SCHEMA).parquet(bronze_path)
    cleaned = silver_plan.silver_for_write(raw, lookup, "silver_stream")
    return append_to_table(cleaned, out, checkpoint, "silver_results")


def silver_batches(
    spark: SparkSession, bronze_path: str, lookup: Callable[[SparkSession], CodeLookup], out: str, metrics_out: str, checkpoint: str, max_files: int = 1000
) -> StreamingQuery:
    """Silver, with the country table resolved again for each micro-batch and the quality metrics kept.

    A stream-static join holds on to the static side's file list; here ``lookup`` is
    called for every batch, so a country file that lands between two batches of one
    run counts for the second.  A batch owns the folders ``batch=<id>`` below ``out``
    and ``metrics_out`` and replaces them if it is repeated after a failure.
    """

    def each(rows: DataFrame, batch_id: int) -> None:
        session = rows.sparkSession
        metrics = silver_plan.SilverMetrics()
        cleaned = silver_plan.silver_for_write(rows, lookup(session), metrics)
        write_table(cleaned, f"{out}/batch={batch_id}")
        session.createDataFrame([metrics.get()]).write.mode("overwrite").parquet(f"{metrics_out}/batch={batch_id}")

    raw = spark.readStream.schema(RAW_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(bronze_path)
    writer = raw.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).queryName("silver_results")
    return writer.trigger(availableNow=True).start()


def fact_stream(spark: SparkSession, silver_path: str, silver_schema: StructType, out: str, checkpoint: str) -> StreamingQuery:
    """Gold fact: streaming projection of the silver table."""
    rows = spark.readStream.schema(silver_schema).parquet(silver_path)
    return append_to_table(star.fact_results(rows), out, checkpoint, "gold_fact")
