"""File sources and sinks: CSV folders in, Parquet layer tables out.

CSV options follow Spark's defaults (quote ``"``, escape ``\\``), so a
RFC-4180 field with doubled quotes arrives with its quotes; the name
cleaner handles that.  Writers keep leading/trailing blanks, which Spark's
CSV writer would otherwise strip (dirty values are part of the data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stridelake.schemas import RAW_SCHEMA, ROW_PLACE

CSV_READ_OPTIONS = {"header": "true", "encoding": "UTF-8"}
CSV_WRITE_OPTIONS = {
    "header": "true",
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

#: Keys are hashes in hex, which zstandard halves and Snappy leaves as they are once a file has too many for a dictionary.
TABLE_COMPRESSION = "zstd"

#: Bytes of a column's dictionary: at the default of 1 MB, 15,000 keys (64 digits each) end it and every row repeats its key.
DICTIONARY_BYTES = 16 << 20

#: Of every stored table, streamed or not. Result ids differ in every row: no dictionary is begun for them.
PARQUET_OPTIONS = {"parquet.dictionary.page.size": str(DICTIONARY_BYTES), "parquet.enable.dictionary#result_id": "false"}


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", compression: str = "none") -> None:
    df.write.mode(mode).options(**CSV_WRITE_OPTIONS, compression=compression).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | None = RAW_SCHEMA) -> DataFrame:
    """Batch CSV read with a pinned schema (no inference pass)."""
    return spark.read.options(**CSV_READ_OPTIONS).schema(schema).csv(path)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Batch CSV read with schema inference (one extra full pass over the files)."""
    return spark.read.options(**CSV_READ_OPTIONS, inferSchema="true").csv(path)


def stream_csv(
    spark: SparkSession, folder: str, schema: StructType = RAW_SCHEMA, max_files_per_trigger: int = 1000
) -> DataFrame:
    """Unbounded CSV folder source: every new file is picked up once.

    ``maxFilesPerTrigger`` bounds each micro-batch (a backlog of many files
    is processed as several batches, also under ``availableNow``).
    """
    return (
        spark.readStream.options(**CSV_READ_OPTIONS)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .schema(schema)
        .csv(folder)
    )


def schema_report(df: DataFrame) -> list[tuple[int, str, str]]:
    """(position, name, type) for each field of a source's schema."""
    return [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]


def with_row_place(df: DataFrame) -> DataFrame:
    """Rows of a plain Parquet scan (columns chosen or renamed, rows filtered) with file and row number as ``ROW_PLACE``.

    Any other DataFrame comes back as it is: behind a join or an explode a stored
    row may stand for several.
    """
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    if plan.children().nonEmpty() or df.isStreaming or "parquet" not in plan.toString().split("\n")[0]:
        return df
    return df.withColumn(ROW_PLACE, F.concat_ws("#", "_metadata.file_path", F.col("_metadata.row_index").cast("string")))


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Materialised table: a full recompute replaces the previous version."""
    df.write.mode(mode).options(compression=TABLE_COMPRESSION, **PARQUET_OPTIONS).parquet(path)
