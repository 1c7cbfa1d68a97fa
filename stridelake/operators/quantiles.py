"""Quantiles from mergeable sketches, and layouts that use them.

A KLL sketch is some kilobytes whatever the number of rows: tasks build partial
sketches, which merge in any order and can be stored and merged again later (a
sketch a day, a quantile of the year).  The price is a stated error: the rank of
an answer is off by at most ``rank_error(k)`` of the rows, with a probability of
99 %.  ``profile.stats_with_median`` is the exact way, for columns of few values.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Size parameter of sketches; the error falls nearly in proportion.
K = 200


def rank_error(k: int = K) -> float:
    """The part of all rows by which the rank of an answer may be off (99 % of the time): the library's fit for one quantile."""
    return 2.296 / k**0.9723


def sketch(values: Column, k: int = K) -> Column:
    """Aggregate: the sketch of a column's values, nulls ignored."""
    return F.kll_sketch_agg_double(values.cast("double"), F.lit(k))


def sketch_by(df: DataFrame, value: str, *keys: str, k: int = K) -> DataFrame:
    """Keys, ``n`` (values that are not null) and ``sketch``: a table of partial sketches to store and merge."""
    return df.groupBy(*keys).agg(F.count(value).alias("n"), sketch(F.col(value), k).alias("sketch"))


def merged(sketches: DataFrame, *keys: str, k: int = K) -> DataFrame:
    """Rows of ``sketch_by`` merged to one for each combination of ``keys``."""
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def at(sketches: DataFrame, ranks: dict[str, float]) -> DataFrame:
    """``sketches`` with a column for each named rank between 0 and 1 instead of the sketch; null where there are no values."""
    found = {name: F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(rank))) for name, rank in ranks.items()}
    return sketches.withColumns(found).drop("sketch")


def cuts(spark: SparkSession, stored: bytes, ranges: int) -> list[float]:
    """Values that cut the sketched rows into ``ranges`` of about as many rows each; a value that fills several is repeated."""
    one = spark.range(1).select(F.lit(bytearray(stored)).alias("s"))
    n = F.kll_sketch_get_n_double("s")
    wanted = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    found = one.select(F.when(n > 0, F.kll_sketch_get_quantile_double("s", wanted)).alias("cuts")).first()["cuts"]
    return [] if found is None else sorted(found)


def _place(value: Column, points: list[float], places: list[int], strict: bool) -> Column:
    """``places[i]`` for the i-th interval between the points, by binary decisions; a point itself belongs to the interval before it (``strict``) or after."""
    if not points:
        return F.lit(places[0])
    m = len(points) // 2
    before = value <= points[m] if strict else value < points[m]
    return F.when(before, _place(value, points[:m], places[: m + 1], strict)).otherwise(_place(value, points[m + 1 :], places[m + 1 :], strict))


def laid_out(df: DataFrame, measure: str, points: list[float], salt: Column, partitions: int) -> DataFrame:
    """``df`` in ``partitions`` ranges of ``measure``, in one exchange and without a sampling run.

    ``points`` come from ``cuts``: known before the rows are computed, so a join
    below runs once.  A value that fills several ranges is dealt over them by ``salt``.
    """
    distinct = sorted(set(points))
    value = F.col(measure)
    low = _place(value, distinct, [bisect_left(points, x) for x in distinct] + [len(points)], strict=True)
    high = _place(value, distinct, [0] + [bisect_right(points, x) for x in distinct], strict=False)
    ranges = len(points) + 1
    pieces = max(1, partitions // ranges)  # a range of more than one partition is dealt by the salt as well
    part = F.coalesce(low + F.pmod(salt, high - low + 1), F.lit(0)) * pieces + F.pmod(F.shiftright(salt, 20), F.lit(pieces))
    return df.withColumn("__part", part.cast("int")).repartitionById(ranges * pieces, "__part").drop("__part").sortWithinPartitions(measure)
