"""Literal edge cases for every cleaning rule (expected values: FIXTURES.md §4)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stridelake.functions.naming import snake_case, snake_case_columns
from stridelake.operators import cleaning as C
from stridelake.operators.lookup import CodeLookup

PERFORMANCE = [
    # distance, performance, event name, type, duration, distance, speed
    ("50km", "5:30:00 h", "Ultra (USA)", "Distance", 5.5, 50.0, 9.09),
    ("50mi", "1d 02:00:00 h", "U", "Distance", 26.0, 80.467, 3.09),
    ("50 Miles", "5:00:00 h", "U", "Distance", 5.0, 80.467, 16.09),
    ("24h", "155.589 mi", "U", "Time", 24.0, 250.396, 10.43),
    ("12:30h", "100.0 km", "U", "Time", 12.5, 100.0, 8.0),
    ("6d", "500.0 km", "U", "Time", 144.0, 500.0, 3.47),
    ("50k", "3d 15:00:00", "U", "Distance", 87.0, 50.0, 0.57),
    ("100km/2Etappen", "12:15:30 h", "U", "Distance", 12.258, 100.0, 8.16),
    ("50km", "10:00:00 h", "Fotrally 1", "Endurance", 10.0, 50.0, 5.0),
    ("50km", "4:45 h", "U", "Distance", 4.013, 50.0, 12.46),
    ("24h", "150,5 km", "U", "Time", 24.0, 150.0, 6.25),
    ("50km", "DNF", "U", "Distance", None, 50.0, None),
    ("50km", None, "U", "Distance", None, 50.0, None),
    ("24h", None, "U", "Time", 24.0, None, None),
    ("3Runden", "5:00:00 h", "U", "Distance", 5.0, None, None),
    ("100m", "0:00:12 h", "U", "Distance", 0.003, None, None),
    ("0h", "10 km", "U", "Time", 0.0, 10.0, None),
    ("1.2.3km", "5:00:00 h", "U", "Distance", 5.0, None, None),
]


def test_performance_metrics(spark):
    rows = [(i, d, p, n) for i, (d, p, n, *_rest) in enumerate(PERFORMANCE)]
    df = spark.createDataFrame(rows, "i int, event_distance_length string, athlete_performance string, event_name string")
    out = {r.i: r for r in C.add_performance_metrics(df).collect()}
    for i, (_d, _p, _n, etype, duration, distance, speed) in enumerate(PERFORMANCE):
        got = out[i]
        assert (got.event_type, got.duration_h, got.distance_km, got.speed_km_h) == (etype, duration, distance, speed), i


DATES = [
    ("14.01.2020", False, dt.date(2020, 1, 14), dt.date(2020, 1, 14)),
    ("10.-11.01.2020", False, dt.date(2020, 1, 10), dt.date(2020, 1, 11)),
    ("30.04-02.05.2020", False, dt.date(2020, 4, 30), dt.date(2020, 5, 2)),
    ("30.04.-02.05.2020", False, dt.date(2020, 4, 30), dt.date(2020, 5, 2)),
    ("31.12.2019-01.01.2020", False, dt.date(2019, 12, 31), dt.date(2020, 1, 1)),
    ("00.05.2020", True, dt.date(2020, 5, 1), dt.date(2020, 5, 1)),
    ("00.00.2020", True, dt.date(2020, 1, 1), dt.date(2020, 1, 1)),
    ("00.-02.05.2020", True, dt.date(2020, 5, 1), dt.date(2020, 5, 2)),
    ("31.02.2020", False, None, None),
    ("unknown", False, None, None),
    ("a-b", False, None, None),
    (None, False, None, None),
]


def test_event_dates(spark):
    df = spark.createDataFrame([(i, d[0]) for i, d in enumerate(DATES)], "i int, event_dates string")
    out = {r.i: r for r in C.normalize_event_dates(df).collect()}
    for i, (_raw, est, start, end) in enumerate(DATES):
        assert (out[i].is_estimated_date, out[i].event_start_date, out[i].event_end_date) == (est, start, end), i


NAMES = [
    ("Ultra (USA)", "Ultra", "USA"),
    ('"""Night"" Run (SWE)"', 'Night" Run', "SWE"),
    ("(SWE)", "(SWE)", "SWE"),
    ("Ultra (swe)", "Ultra (swe)", ""),
    ("No Code Run", "No Code Run", ""),
    (None, None, None),
]


def test_event_names(spark):
    df = spark.createDataFrame([(i, n[0]) for i, n in enumerate(NAMES)], "i int, event_name string")
    out = {r.i: r for r in C.parse_event_names(df).collect()}
    for i, (_raw, name, code) in enumerate(NAMES):
        assert (out[i].event_name_cleaned, out[i].event_country_code) == (name, code), i


def _lookup(spark):
    dim = spark.createDataFrame([("SWE", "Sweden"), ("USA", "United States")], "iso_code string, country_name string")
    return CodeLookup.prepare(dim)


def test_country_lookup_and_global_events(spark):
    lookup = _lookup(spark)
    rows = [
        (0, "swe", "Ultra (SWE)"),
        (1, "XXX", "Wings for Life World Run (XXX)"),
        (2, None, "No Code Run"),
        (3, "ZZZ", "Ultra (USA)"),
    ]
    df = spark.createDataFrame(rows, "i int, athlete_country string, event_name string")
    out = (
        df.transform(C.parse_event_names)
        .transform(C.add_event_country, lookup)
        .transform(C.mark_global_events)
        .transform(C.add_athlete_country, lookup)
    )
    got = {r.i: (r.athlete_country, r.athlete_country_name, r.event_country_code, r.event_country_name) for r in out.collect()}
    assert got[0] == ("SWE", "Sweden", "SWE", "Sweden")
    assert got[1] == ("XXX", "Unknown", "GLO", "Global")
    assert got[2] == (None, "Unknown", "", "Unknown")
    assert got[3] == ("ZZZ", "Unknown", "USA", "United States")


def test_lookup_of_known_small_size_is_broadcast_and_never_multiplies_rows(spark):
    dim = spark.createDataFrame([("SWE", "Sweden"), ("SWE", "Sverige")], "iso_code string, country_name string")
    lookup = CodeLookup.prepare(dim)
    df = spark.createDataFrame([("SWE",), ("SWE",)], "athlete_country string")
    out = C.add_athlete_country(df, lookup)
    assert out.count() == 2
    assert {r.athlete_country_name for r in out.collect()} == {"Sverige"}
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()


def test_lookup_beyond_the_byte_threshold_is_a_plain_join(spark):
    dim = spark.createDataFrame([("SWE", "Sweden"), ("USA", "United States")], "iso_code string, country_name string")
    lookup = CodeLookup.prepare(dim)
    df = spark.createDataFrame([("usa",)], "athlete_country string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10b")
    try:
        out = C.add_athlete_country(df, lookup)
        assert out.first().athlete_country_name == "United States"
        assert "hint" not in out._jdf.queryExecution().optimizedPlan().toString().lower()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_later_country_name_is_a_correction(spark):
    dim = spark.createDataFrame(
        [("SWE", "Aaland", 1), ("SWE", "Sverige", 2), ("NOR", "B", 5), ("NOR", "A", 5)], "iso_code string, country_name string, at int"
    )
    names = {r.code: r.name for r in CodeLookup.prepare(dim, order_col="at").table.collect()}
    assert names == {"SWE": "Sverige", "NOR": "A"}


def test_uncastable_sorts_on_every_column(spark):
    from stridelake.operators import profile

    df = spark.createDataFrame([("b", "1", "p", "x"), ("a", "1", "p", "x")], "`Event name` string, `Event distance/length` string, `Athlete performance` string, `Athlete average speed` string")
    assert [r.Event for r in profile.uncastable(df).collect()] == ["a", "b"]


def test_scratch_needs_a_shared_folder_off_local_masters():
    from types import SimpleNamespace

    from stridelake.session import scratch_root

    def session(master, conf=None):
        context = SimpleNamespace(master=master, applicationId="app-test", getCheckpointDir=lambda: None)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d=None: conf or d))

    assert scratch_root(session("spark://host:7077", "hdfs://shared/ckpt/")) == "hdfs://shared/ckpt"
    assert scratch_root(session("local[4]")) == scratch_root(session("local[4]"))
    for master in ("spark://host:7077", "yarn", "k8s://x", "local-cluster[3,2,1024]"):
        with pytest.raises(RuntimeError):
            scratch_root(session(master))


@pytest.mark.parametrize(
    "raw, expected",
    [(" m", "M"), ("female", "F"), ("X", "X"), (None, "U"), ("?", "U")],
)
def test_gender(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "athlete_gender string")
    assert C.normalize_gender(df).first().athlete_gender == expected


@pytest.mark.parametrize(
    "raw, expected",
    [("F40", "W40"), (" w23 ", "W23"), ("MU20", "MU20"), (None, "Unknown"), ("   ", "")],
)
def test_age_category(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "athlete_age_category string")
    assert C.normalize_age_category(df).first().athlete_age_category == expected


def test_quality_gate(spark):
    rows = [
        (0, 14.0, 10.0), (1, 15.0, 10.0), (2, 100.0, 10.0), (3, 101.0, 10.0), (4, None, 10.0),
        (5, 30.0, 21.19), (6, 30.0, 21.2), (7, 30.0, None),
    ]
    df = spark.createDataFrame(rows, "i int, athlete_age double, speed_km_h double").withColumns(
        {"distance_km": F.lit(50.0), "duration_h": F.lit(5.0)}
    )
    kept = sorted(r.i for r in C.quality_gate(df).collect())
    assert kept == [1, 2, 4, 5]


def test_athlete_identity_hash(spark):
    df = spark.createDataFrame(
        [(7, "M", "Sweden", 1980.0), (7, "M", "Sweden", None), (None, "F", "Unknown", 1990.0)],
        "athlete_id int, athlete_gender string, athlete_country_name string, athlete_year_of_birth double",
    )
    import hashlib

    got = [r.athlete_id for r in C.add_athlete_identity(df).collect()]
    expect = [
        hashlib.sha256(b"7_M_Sweden_1980.0").hexdigest(),
        hashlib.sha256(b"7_M_Sweden_UNKNOWN").hexdigest(),
        hashlib.sha256(b"F_Unknown_1990.0").hexdigest(),
    ]
    assert got == expect


def test_snake_case():
    assert snake_case("Event distance/length") == "event_distance_length"
    assert snake_case("  Athlete ID ") == "athlete_id"


def test_snake_case_refuses_collisions(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `a/b` int")
    with pytest.raises(ValueError):
        snake_case_columns(df)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_ansi_on_and_off_agree(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = [(i, d, p, n) for i, (d, p, n, *_rest) in enumerate(PERFORMANCE)]
        df = spark.createDataFrame(
            rows, "i int, event_distance_length string, athlete_performance string, event_name string"
        )
        got = sorted((r.i, r.duration_h, r.distance_km, r.speed_km_h) for r in C.add_performance_metrics(df).collect())
        assert got == [(i, p[4], p[5], p[6]) for i, p in enumerate(PERFORMANCE)]
        dates = spark.createDataFrame([(d[0],) for d in DATES], "event_dates string")
        assert C.normalize_event_dates(dates).count() == len(DATES)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.mark.parametrize(
    "values, median",
    [([1.0, 2.0, 3.0, 4.0], 2.0), ([1.0, 2.0, 3.0, 4.0, 5.0], 3.0), ([5.0, 5.0, 5.0, 1.0], 5.0), ([None, 7.0], 7.0)],
)
def test_exact_median(spark, values, median):
    from stridelake.operators.profile import stats_with_median

    df = spark.createDataFrame([(v,) for v in values], "x double")
    names = {"min": "lo", "max": "hi", "mean": "mean", "median": "med"}
    row = stats_with_median(df, "x", names).first()
    present = [v for v in values if v is not None]
    assert (row.lo, row.hi, row.med) == (min(present), max(present), median)
    assert row.mean == sum(present) / len(present)


def test_exact_median_equals_percentile_approx_at_full_accuracy(spark):
    from stridelake.operators.profile import stats_with_median

    df = spark.range(0, 5001).select(((F.col("id") * 7919) % 97).cast("double").alias("x"))
    exact = stats_with_median(df, "x", {"min": "a", "max": "b", "mean": "c", "median": "m"}).first().m
    approx = df.agg(F.percentile_approx("x", 0.5, 1_000_000).alias("m")).first().m
    assert exact == approx
