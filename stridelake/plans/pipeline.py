"""Batch pipeline: bronze -> silver -> gold, each layer written as a table.

Writing each layer is the lineage cut: a lost executor re-runs only tasks of
the current layer, never the whole chain, and ``result_id`` (random) is fixed
once silver is written.  Each run writes a version of its own and publishes it
at the end (``plans.store``): readers never meet a half-written layer, and a
failed run leaves the published version as it was.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.operators import quantiles, star
from stridelake.plans import silver as silver_plan
from stridelake.plans import store
from stridelake.plans.lake import StoredLake
from stridelake.schemas import TABLES
from stridelake.session import jit_sized_codegen, new_run_dir
from stridelake.sources import fixture
from stridelake.sources.files import write_table

#: Ranges of a mart's measure; a range of more rows than one partition should hold is dealt over several.
RANGES = 64


class GrowingLake(StoredLake):
    """A batch lake of one new version whose tables are written when they are first read.

    A question that needs bronze waits for bronze alone: silver, the star and the
    marts are written (once, each from the stored tables below it) for the first
    question that reads them.  ``complete`` writes what is missing and publishes.
    """

    def __init__(self, spark: SparkSession, root: str, raw: DataFrame, countries: DataFrame, materialize_marts: bool = True):
        store.expect_kind(spark, root, "batch")
        self.spark, self.root, self.version = spark, root.rstrip("/"), store.new_version()
        self.tables, self.arrivals = {}, {}
        self._sources = {"raw_marathon": raw, "dim_countries": countries}
        self._names = [name for name in TABLES if materialize_marts or name not in silver_plan.MARTS]
        self._metrics = silver_plan.SilverMetrics()
        self._lock = threading.RLock()

    @cached_property
    def raw(self) -> DataFrame:
        return self._read("raw_marathon")

    @cached_property
    def countries(self) -> DataFrame:
        return self._read("dim_countries")

    @property
    def quality(self) -> dict:
        """Metrics of the silver write."""
        self.path("marathon_obt")
        return self._metrics.get()

    def source(self, name: str) -> DataFrame:
        """A bronze table for a reader that stores all its rows itself: as stored if it is, else without a copy on the way."""
        return self._read(name) if name in self.tables else self._sources[name]

    def _derived(self, name: str) -> DataFrame:
        if name in self._sources:
            return self._sources[name]
        if name == "marathon_obt":  # row maps + two lookups against the small country table
            return silver_plan.silver_for_write(self.raw, self.lookup, self._metrics)
        if name in silver_plan.MARTS:
            mart = star.mart_distance_from_silver if name == "mart_distance" else star.mart_time_from_silver
            silver, events = self.silver, self.dim_event
            return clustered(mart(silver, events), name, self._metrics.sketches()[name])
        # The fact is a projection; dimensions are two-phase distinct aggregates.
        return {"fct_results": star.fact_results, "dim_athlete": star.dim_athlete, "dim_event": star.dim_event, "dim_date": star.dim_date}[name](self.silver)

    def path(self, name: str) -> str:
        with self._lock:
            if name not in self.tables:
                folder = store.folder(self.version, name)
                # Also for bronze: a source's projection of many texts is too large a method for the JIT as well.
                with jit_sized_codegen(self.spark):
                    write_table(self._derived(name), f"{self.root}/{folder}")
                self.tables[name] = folder
        return super().path(name)

    def _stored(self, name: str, otherwise: Callable[[], DataFrame]) -> DataFrame:
        return self._read(name) if name in self._names else otherwise()

    def register_tables(self, prefix: str = "") -> list[str]:
        self.complete()
        return super().register_tables(prefix)

    def complete(self) -> None:
        for name in self._names:
            self.path(name)
        store.publish(self.spark, self.root, "batch", self.version, self.tables)


def run_pipeline(
    spark: SparkSession, raw: DataFrame, countries: DataFrame, root: str, materialize_marts: bool = True
) -> StoredLake:
    """Write every layer of a new version under ``root``, publish it, return it.

    With ``materialize_marts`` the two marts are written once, so questions
    scan one table instead of repeating the star join (two fact-sized
    shuffles) per question.  Otherwise they are views of this version.
    """
    growing = GrowingLake(spark, root, raw, countries, materialize_marts)
    growing.complete()
    lake = StoredLake(spark, root)
    lake.quality = growing.quality
    return lake


def clustered(mart: DataFrame, name: str, sketch: bytes) -> DataFrame:
    """The rows of a mart in ranges of the measure that questions filter on.

    A file then holds a narrow range of it, so footers' statistics skip whole
    files.  The ranges come from the sketch that the write of silver took, so
    neither silver nor the join is run a second time to find them.  A hash of the
    row spreads a measure that very many rows share (50 km) over as many
    partitions as it fills.
    """
    spark = mart.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    points = quantiles.cuts(spark, sketch, min(RANGES, partitions))
    salt = F.xxhash64("event", "date", "athlete_speed_km_h")
    return quantiles.laid_out(mart, "event_distance" if name == "mart_distance" else "event_time_h", points, salt, partitions)


_LAKES: dict[tuple[str, str], GrowingLake] = {}
_LOCK = threading.Lock()


def lake_for(spark: SparkSession, sf_dir: str) -> GrowingLake:
    """The stored lake for a test-data folder, each table written once per Spark application, when it is first read."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _LOCK:
        lake = _LAKES.get(key)
        if lake is None:
            root = new_run_dir(spark, "lake")
            lake = GrowingLake(spark, root, fixture.raw_results(spark, sf_dir), fixture.countries(spark, sf_dir))
            _LAKES[key] = lake
        return lake
