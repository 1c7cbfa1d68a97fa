"""Race-shaped inputs derived from the driver's TPC-H-like tables.

The test data has no race results, so a deterministic projection turns
``lineitem ⋈ orders ⋈ customer`` into the raw 13-column results shape (one row
per line item) and ``nation`` into the country table.  The projection is the
one documented in FIXTURES.md §2; it exercises every date shape, name shape,
distance unit and dirty value the cleaning rules care about, and its size
grows with the input tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.schemas import RAW_COLUMNS


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _two_digits(x: Column) -> Column:
    return F.lpad(x.cast("string"), 2, "0")


def _code(k: Column) -> Column:
    """Three-letter code 'N' + two letters taken from k (0..24)."""
    return F.concat(
        F.lit("N"),
        F.char(F.lit(65) + F.floor(k / 5)),
        F.char(F.lit(65) + k % 5),
    )


def _pick(selector: Column, options: list[Column | str], default: Column | str | None = None) -> Column:
    """``options[selector]`` as a CASE over the selector value."""
    out = None
    for i, value in enumerate(options):
        value = F.lit(value) if isinstance(value, str) else value
        out = F.when(selector == i, value) if out is None else out.when(selector == i, value)
    if default is not None:
        out = out.otherwise(F.lit(default) if isinstance(default, str) else default)
    return out


def raw_results(spark: SparkSession, sf_dir: str, with_row_key: bool = False) -> DataFrame:
    """Raw results with the 13 original column names (bronze shape)."""
    # The joins take only what the projection reads, as whole numbers: doubles and times are
    # costly to shuffle.  Orders meet customers first, so line items are dealt once, by order.
    li = _table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("e"),
        F.col("l_orderkey").alias("lk"),
        F.col("l_linenumber").alias("ln"),
        F.col("l_partkey").alias("pk"),
        F.year("l_shipdate").alias("y"),
        F.floor("l_extendedprice").alias("p"),
        F.floor("l_quantity").cast("int").alias("q"),
    )
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("ck"))
    customer = _table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nk"))
    placed = orders.join(customer, F.col("ck") == customer.c_custkey).select("o_orderkey", "ck", "nk")

    # Stage 1: integer inputs.  Stage 2: the short text pieces.  Each stage
    # is referenced several times by the next one, so Catalyst keeps them as
    # separate projections instead of copying the expressions into every use.
    base = li.join(placed, F.col("lk") == F.col("o_orderkey")).drop("o_orderkey")
    e, lk, ln, ck, y, p, q = (F.col(c) for c in ["e", "lk", "ln", "ck", "y", "p", "q"])
    tw = F.when(e % 10 == 0, ln % 2).otherwise(F.lit(0))
    pieces = base.select(
        "*",
        _two_digits(1 + (e * 3 + y) % 24 + tw).alias("d1"),
        _two_digits(2 + (e * 3 + y) % 24 + tw).alias("d2"),
        _two_digits(1 + (e * 7 + y) % 11).alias("m1"),
        _two_digits(2 + (e * 7 + y) % 11).alias("m2"),
        (10800 + p % 90000).alias("sec"),
        y.cast("string").alias("ys"),
        e.cast("string").alias("es"),
        # No nation has the code QQQ: these events and athletes resolve to "Unknown".
        F.when(e % 31 == 0, F.lit("QQQ")).otherwise(_code(e % 25)).alias("ec"),
        F.when(ck % 47 == 0, F.lit("QQQ")).otherwise(_code(F.col("nk"))).alias("ac"),
        # Some events have a race of another type under the same name and year.
        F.when((e % 11 == 3) & (lk % 2 == 0), (e + 4) % 9).otherwise(e % 9).alias("dk"),
    )
    d1, d2, m1, m2, sec, ys, es, ec, ac, dk = (
        F.col(c) for c in ["d1", "d2", "m1", "m2", "sec", "ys", "es", "ec", "ac", "dk"]
    )

    event_dates = _pick(
        e % 8,
        [
            F.concat_ws(".", d1, m1, ys),
            F.concat(d1, F.lit(".-"), d2, F.lit("."), m1, F.lit("."), ys),
            F.concat(d1, F.lit("."), m1, F.lit("-"), d2, F.lit("."), m2, F.lit("."), ys),
            F.concat(d1, F.lit("."), m1, F.lit(".-"), d2, F.lit("."), m2, F.lit("."), ys),
            F.concat(d1, F.lit(".12."), (y - 1).cast("string"), F.lit("-"), d2, F.lit(".01."), ys),
            F.concat(F.lit("00."), m1, F.lit("."), ys),
            F.concat(F.lit("00.00."), ys),
        ],
        "unknown",
    )
    event_name = _pick(
        e % 7,
        [
            F.concat(F.lit("Fotrally "), es, F.lit(" (SWE)")),
            F.concat(F.lit("Wings for Life World Run "), es, F.lit(" (XXX)")),
            F.concat(F.lit('"""Night"" Run '), es, F.lit(" ("), ec, F.lit(')"')),
            F.concat(F.lit("No Code Run "), es),
        ],
        F.concat(F.lit("Ultra "), es, F.lit(" ("), ec, F.lit(")")),
    )
    distance = _pick(
        dk,
        ["50km", "100km/2Etappen", "50mi", "50k", "24h", "6h", "6d", "12:30h", "3Runden"],
    )
    clock = F.concat(
        F.when(sec >= 86400, F.lit("1d ")).otherwise(F.lit("")),
        F.floor(sec % 86400 / 3600).cast("string"),
        F.lit(":"),
        _two_digits(F.floor(sec % 3600 / 60)),
        F.lit(":"),
        _two_digits(sec % 60),
        F.lit(" h"),
    )
    reached = F.concat(
        (3 * q + 20).cast("string"),
        F.lit("."),
        F.lpad((p % 1000).cast("string"), 3, "0"),
        F.when(lk % 4 == 0, F.lit(" mi")).otherwise(F.lit(" km")),
    )
    performance = (
        F.when(lk % 97 == 0, F.lit(None).cast("string"))
        .when(lk % 89 == 0, F.lit("DNF"))
        .when((e % 7 == 0) | dk.isin(0, 1, 2, 3, 8), clock)
        .otherwise(reached)
    )
    club = F.when(ck % 8 < 3, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("Club "), (ck % 40).cast("string"))
    )
    country = (
        F.when(ck % 50 == 0, F.lit(None).cast("string"))
        .when(ck % 49 == 0, F.lit("XXX"))
        .when(ck % 3 == 0, F.lower(ac))
        .otherwise(ac)
    )
    birth = F.when(ck % 13 == 0, F.lit(None).cast("double")).otherwise(
        (1910 + ck % 100).cast("double")
    )
    gender = _pick(ck % 6, ["M", "F", " m", "female", "X"])
    category = _pick(ck % 5, ["M35", "F40", " w23 ", "MU20"])
    speed = (
        F.when(lk % 101 == 0, F.lit(None).cast("string"))
        .when(lk % 53 == 0, F.lit("11:22:33"))
        .otherwise(
            F.concat((4 + p % 12).cast("string"), F.lit("."), _two_digits(p % 100))
        )
    )
    values = [
        y.cast("int"),
        event_dates,
        event_name,
        distance,
        (e * 10 + y % 10).cast("int"),
        performance,
        club,
        country,
        birth,
        gender,
        category,
        speed,
        (ck % 500).cast("int"),
    ]
    cols = [v.alias(name) for v, name in zip(values, RAW_COLUMNS)]
    if with_row_key:
        cols.append(
            F.concat_ws("_", lk.cast("string"), ln.cast("string"), es, F.col("pk").cast("string")).alias("row_key")
        )
    return pieces.select(*cols)


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country table: one row per nation."""
    return _table(spark, sf_dir, "nation").select(
        _code(F.col("n_nationkey")).alias("iso_code"),
        F.col("n_name").alias("country_name"),
    )
