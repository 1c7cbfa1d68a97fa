"""A hot key holding a third of the fact rows: joins split it, aggregates pre-combine it.

The test data is small, so the session thresholds are lowered to what a
cluster sees at scale (sort-merge joins, partitions of a few KB); the plans
and results are then checked.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import functions as F

from stridelake.operators import star
from stridelake.plans.pipeline import lake_for
from tests.conftest import SF_SMALL

SMALL_CLUSTER_SHAPE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.shuffle.partitions": "16",
}


@contextmanager
def session_conf(spark, conf: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _skewed_fact(lake):
    """The fact table plus copies of one Distance event's rows, so that this
    event holds about a third of all rows (work still grows with the data)."""
    fact = lake.fact
    dims = lake.dim_event.filter(F.col("event_type") == "Distance")
    hot = dims.select("event_id").orderBy("event_id").first().event_id
    n_fact, n_hot = fact.count(), fact.filter(F.col("event_id") == hot).count()
    copies = max(1, (n_fact // 2) // max(n_hot, 1))
    extra = fact.filter(F.col("event_id") == hot).withColumn(
        "__copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))
    ).drop("__copy")
    return fact.unionByName(extra), hot


def test_hot_event_key_is_split_by_the_join(spark):
    lake = lake_for(spark, SF_SMALL)
    fact, hot = _skewed_fact(lake)
    share = fact.filter(F.col("event_id") == hot).count() / fact.count()
    assert share > 0.3

    with session_conf(spark, {**SMALL_CLUSTER_SHAPE, "spark.sql.adaptive.skewJoin.enabled": "false"}):
        expected = sorted(map(repr, star.mart_distance(fact, lake.dim_event, lake.dim_athlete, lake.dim_date).collect()))
    with session_conf(spark, SMALL_CLUSTER_SHAPE):
        mart = star.mart_distance(fact, lake.dim_event, lake.dim_athlete, lake.dim_date)
        got = sorted(map(repr, mart.collect()))
        final_plan = mart._jdf.queryExecution().executedPlan().toString()
    assert got == expected
    assert "SortMergeJoin" in final_plan
    assert "skew=true" in final_plan or "isSkewJoin=true" in final_plan, final_plan[:3000]


def test_hot_key_is_combined_before_the_shuffle(spark):
    """Dimensions and per-group counts aggregate map-side first: the hot key
    reaches the shuffle as one partial row per map task, not as its rows."""
    lake = lake_for(spark, SF_SMALL)
    fact, hot = _skewed_fact(lake)
    with session_conf(spark, SMALL_CLUSTER_SHAPE):
        per_event = fact.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))
        plan = per_event._jdf.queryExecution().executedPlan().toString()
        n_hot = per_event.filter(F.col("event_id") == hot).first().n
    assert plan.count("HashAggregate") >= 2  # partial (map side) + final
    assert n_hot == fact.filter(F.col("event_id") == hot).count()
