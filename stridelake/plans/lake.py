"""The layered tables as lazily built DataFrames.

``RaceLake`` derives every layer from bronze inputs inside one logical plan
(Catalyst prunes what a query does not need).  ``StoredLake`` reads layers
that :func:`stridelake.plans.pipeline.run_pipeline` wrote, so each layer is a
lineage cut and questions only scan the gold tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from stridelake.operators import star
from stridelake.operators.lookup import CodeLookup
from stridelake.plans import silver as silver_plan
from stridelake.plans import store
from stridelake.schemas import TABLES
from stridelake.sources import fixture


class RaceLake:
    def __init__(self, raw: DataFrame, countries: DataFrame):
        self.raw = raw
        self.countries = countries

    @classmethod
    def from_tables(cls, spark: SparkSession, sf_dir: str) -> "RaceLake":
        """Bronze inputs projected from the driver's tables (FIXTURES.md §2)."""
        return cls(fixture.raw_results(spark, sf_dir), fixture.countries(spark, sf_dir))

    @cached_property
    def lookup(self) -> CodeLookup:
        return CodeLookup.prepare(self.countries)

    def enriched(self, with_identity: bool = True) -> DataFrame:
        return silver_plan.enriched(self.raw, self.lookup, with_identity)

    def staged(self) -> DataFrame:
        """``enriched`` for reports that read most of its columns."""
        return silver_plan.staged(self.raw, self.lookup)

    @cached_property
    def silver(self) -> DataFrame:
        return silver_plan.silver(self.raw, self.lookup)

    @cached_property
    def fact(self) -> DataFrame:
        return star.fact_results(self.silver)

    @cached_property
    def dim_athlete(self) -> DataFrame:
        return star.dim_athlete(self.silver)

    @cached_property
    def dim_event(self) -> DataFrame:
        return star.dim_event(self.silver)

    @cached_property
    def dim_date(self) -> DataFrame:
        return star.dim_date(self.silver)

    @cached_property
    def mart_distance(self) -> DataFrame:
        return star.mart_distance(self.fact, self.dim_event, self.dim_athlete, self.dim_date)

    @cached_property
    def mart_time(self) -> DataFrame:
        return star.mart_time(self.fact, self.dim_event, self.dim_athlete, self.dim_date)


class StoredLake(RaceLake):
    """The published version of a lake root (see ``plans.store``); tables that the
    version does not hold are derived from those it does."""

    def __init__(self, spark: SparkSession, root: str):
        now = store.published(spark, root)
        if now is None:
            raise store.NoLake(f"no published lake at {root}")
        self.spark = spark
        self.root = root.rstrip("/")
        self.version = now["version"]
        self.tables = now["tables"]
        self.quality: dict | None = None  # set by a run: metrics of the silver write
        self.arrivals: dict[str, int] = {}  # set by an incremental run: rows that each stream took in
        super().__init__(self._read("raw_marathon"), self._read("dim_countries"))

    def path(self, name: str) -> str:
        return f"{self.root}/{self.tables[name]}"

    def _read(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(self.path(name))
        return df.drop(*TABLES[name].technical)

    def _stored(self, name: str, otherwise: Callable[[], DataFrame]) -> DataFrame:
        return self._read(name) if name in self.tables else otherwise()

    @cached_property
    def lookup(self) -> CodeLookup:
        return silver_plan.country_lookup(self.spark.read.parquet(self.path("dim_countries")))

    @cached_property
    def silver(self) -> DataFrame:
        return self._read("marathon_obt")

    @cached_property
    def fact(self) -> DataFrame:
        return self._read("fct_results")

    @cached_property
    def dim_athlete(self) -> DataFrame:
        return self._stored("dim_athlete", lambda: star.dim_athlete(self.silver))

    @cached_property
    def dim_event(self) -> DataFrame:
        return self._stored("dim_event", lambda: star.dim_event(self.silver))

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._stored("dim_date", lambda: star.dim_date(self.silver))

    @cached_property
    def mart_distance(self) -> DataFrame:
        return self._stored("mart_distance", self.mart_distance_view)

    @cached_property
    def mart_time(self) -> DataFrame:
        return self._stored("mart_time", self.mart_time_view)

    def _fact_rows(self) -> DataFrame:
        """The fact for a join: its table where it is written, else the projection of silver that it is (no copy for the join's sake)."""
        return self.fact if "fct_results" in self.tables else star.fact_results(self.silver)

    def mart_distance_view(self) -> DataFrame:
        """The star join itself, whether or not the mart is stored."""
        return star.mart_distance(self._fact_rows(), self.dim_event, self.dim_athlete, self.dim_date)

    def mart_time_view(self) -> DataFrame:
        return star.mart_time(self._fact_rows(), self.dim_event, self.dim_athlete, self.dim_date)

    def register_views(self, prefix: str = "") -> list[str]:
        """Expose every layer as a session temp view (``spark.sql`` access)."""
        frames = {
            "raw_marathon": self.raw, "dim_countries": self.countries, "marathon_obt": self.silver,
            "fct_results": self.fact, "dim_athlete": self.dim_athlete, "dim_event": self.dim_event,
            "dim_date": self.dim_date, "mart_distance": self.mart_distance, "mart_time": self.mart_time,
        }
        for name, frame in frames.items():
            frame.createOrReplaceTempView(prefix + name)
        return [prefix + n for n in frames]

    def register_tables(self, prefix: str = "") -> list[str]:
        """Catalog namespaces per layer (``bronze``/``silver``/``gold``) with a commented
        name for each layer table: ``spark.table("gold.mart_distance")`` then works,
        and so does ``FROM gold.mart_distance`` in SQL.

        A stored table is an external table; one whose files carry technical columns
        (ingest time, batch) is a view of the others.  A mart that this version does
        not store is a view whose definition is the star join over the registered
        tables, so it follows the tables as they grow.  Registering again, for
        another version or another root, points the names there.  No data is touched.
        """
        for layer in sorted({spec.layer for spec in TABLES.values()}):
            # The databases hold names only; their folder lies beside the data, not in the working directory.
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{prefix}{layer}` LOCATION '{self.root}/_catalog/{prefix}{layer}'")
        names = []
        for spec in TABLES.values():
            names.append(f"{prefix}{spec.layer}.{spec.name}")
            self._forget(names[-1])
            if spec.name not in self.tables:
                self._create_view(names[-1], spec.comment, star.mart_sql(spec.name, f"`{prefix}{spec.layer}`"))
                continue
            stored = self.spark.read.parquet(self.path(spec.name)).columns
            if set(stored) & set(spec.technical):
                columns = ", ".join(f"`{c}`" for c in stored if c not in spec.technical)
                self._create_view(names[-1], spec.comment, f"SELECT {columns} FROM parquet.`{self.path(spec.name)}`")
            else:
                self.spark.catalog.createTable(names[-1], path=self.path(spec.name), source="parquet", description=spec.comment)
        return names

    def _forget(self, name: str) -> None:
        if self.spark.catalog.tableExists(name):
            kind = "VIEW" if self.spark.catalog.getTable(name).tableType == "VIEW" else "TABLE"
            self.spark.sql(f"DROP {kind} {name}")

    def _create_view(self, name: str, comment: str, definition: str) -> None:
        self.spark.sql(f"CREATE OR REPLACE VIEW {name} COMMENT '{comment}' AS {definition}")
