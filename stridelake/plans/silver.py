"""Silver one-big-table: the cleaning steps composed in pipeline order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stridelake.functions import rules as R
from stridelake.functions.naming import snake_case_columns
from stridelake.operators import cleaning as C
from stridelake.operators import quantiles
from stridelake.operators.lookup import CodeLookup
from stridelake.schemas import SILVER_COLUMNS
from stridelake.sources.files import with_row_place


#: Mart: its type of race, the silver column that is its measure.
MARTS = {"mart_distance": (R.EVENT_DISTANCE, "distance_km"), "mart_time": (R.EVENT_TIME, "duration_h")}


def country_lookup(countries: DataFrame) -> CodeLookup:
    """The lookup of a country table; where rows carry their ingest time, the last name of a code counts."""
    return CodeLookup.prepare(countries, order_col="ingested_at" if "ingested_at" in countries.columns else None)


def located(raw: DataFrame, lookup: CodeLookup) -> DataFrame:
    """Dates, event names and both countries resolved (original headers in, snake case out)."""
    return (
        snake_case_columns(raw)
        .transform(C.normalize_event_dates)
        .transform(C.parse_event_names)
        .transform(C.add_event_country, lookup)
        .transform(C.mark_global_events)
        .transform(C.add_athlete_country, lookup)
    )


def identified(df: DataFrame, with_identity: bool = True) -> DataFrame:
    """Performance, person and age columns added to located rows.

    With ``with_identity=False`` the raw (recycled) ``athlete_id`` is kept.
    """
    df = df.transform(C.add_performance_metrics).transform(C.normalize_gender).transform(C.normalize_age_category)
    if with_identity:
        df = df.transform(C.add_athlete_identity)
    return df.transform(C.add_athlete_age)


def performances(raw: DataFrame) -> DataFrame:
    """Type, duration, distance and speed only: no lookup."""
    return snake_case_columns(raw).transform(C.add_performance_metrics)


def people(df: DataFrame, lookup: CodeLookup) -> DataFrame:
    """Gender and country of the athlete (one lookup) on snake-case rows; the raw ``athlete_id`` stays."""
    return df.transform(C.add_athlete_country, lookup).transform(C.normalize_gender)


def incomplete(raw: DataFrame, lookup: CodeLookup) -> DataFrame:
    """Rows that the gate drops for a missing measure; only they are looked up and hashed."""
    return people(C.hold(performances(raw), C.MEASURES).filter(C.is_incomplete()), lookup).transform(C.add_athlete_identity)


def enriched(raw: DataFrame, lookup: CodeLookup, with_identity: bool = True) -> DataFrame:
    """All cleaning and enrichment, before the quality gate: plain projections and
    two lookups, so Catalyst prunes what a report does not read."""
    return identified(located(raw, lookup), with_identity)


def staged(raw: DataFrame, lookup: CodeLookup) -> DataFrame:
    """``enriched`` for reports that read most of its columns: the cleaning in two
    generated stages (as in the write of silver), each small enough for the JIT."""
    return identified(located(raw, lookup).observe("located", F.count(F.lit(1)).alias("rows")))


def silver(raw: DataFrame, lookup: CodeLookup) -> DataFrame:
    """The cleaned results table (25 columns), usable with ``transform`` and unions.

    Over a stored bronze table it is deterministic, ids included, so a query's
    filters on unparsed columns reach the scan.
    """
    return enriched(with_row_place(raw), lookup).transform(C.quality_gate).transform(C.add_keys).select(*SILVER_COLUMNS)


class SilverMetrics:
    """Metrics of one write of silver: unresolved countries, the quality gate, and
    sketches of the two measures by which the marts are laid out."""

    def __init__(self) -> None:
        self.countries, self.gate = Observation(), Observation()

    def get(self) -> dict:
        """The counts, once the write is done."""
        return {name: n for name, n in {**self.countries.get, **self.gate.get}.items() if name not in MARTS}

    def sketches(self) -> dict[str, bytes]:
        """A KLL sketch for each mart, of the measure of its type of race."""
        return {name: bytes(self.gate.get[name]) for name in MARTS}


def silver_for_write(raw: DataFrame, lookup: CodeLookup, metrics: SilverMetrics | str) -> DataFrame:
    """Silver for a write of all its columns, with metrics taken in the same pass.

    The two observations also bound what Catalyst fuses: filters stay above the
    parsing (pushed down, they would parse every text again), and the cleaning
    becomes two generated stages that the JIT accepts.  A query of a few
    columns should read :func:`silver` instead.  ``metrics`` is a name for
    streams, whose progress reports metrics by name.
    """
    stream = isinstance(metrics, str)
    countries, gate = (f"{metrics}_countries", f"{metrics}_gate") if stream else (metrics.countries, metrics.gate)
    rows = located(with_row_place(raw), lookup).observe(
        countries,
        F.count_if(F.col("event_country_name") == R.UNKNOWN_LABEL).alias("unknown_event_country"),
        F.count_if(F.col("athlete_country_name") == R.UNKNOWN_LABEL).alias("unknown_athlete_country"),
    )
    sketches = [] if stream else [
        quantiles.sketch(F.when(C.is_plausible() & (F.col("event_type") == kind), F.col(measure))).alias(mart) for mart, (kind, measure) in MARTS.items()
    ]
    rows = identified(rows).observe(gate, *C.gate_metrics(), *sketches)
    return rows.transform(C.quality_gate).transform(C.add_keys).select(*SILVER_COLUMNS)
