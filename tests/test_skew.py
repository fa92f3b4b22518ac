"""A key holding a third of all rows: results stay whole and no task gets
the whole hot group (AQE splits the skewed join partition)."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from runway.operators.aggregates import argmax_by_group, count_by
from runway.operators.quality import fill_group_mean, frames_equal

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _skewed(spark, n=60000):
    # key 0 holds a third of the rows; the rest spread over 500 keys
    k = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500 + 1)
    v = F.when(F.col("id") % 4 != 0, F.col("id") / 7.0)
    return spark.range(n).select(k.alias("k"), v.alias("v"), F.col("id"))


def test_hot_key_fill_splits_and_stays_whole(spark):
    df = _skewed(spark)
    expected = fill_group_mean(df, ["k"], ["v"])          # broadcast path
    with conf(spark, SKEW_CONF):
        got = fill_group_mean(df, ["k"], ["v"], max_groups=0)   # forced shuffle path
        rows = got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "skew=true" in plan, plan
    assert len(rows) == 60000
    assert frames_equal(spark.createDataFrame(rows, got.schema), expected)


def test_hot_key_aggregates_are_partial(spark):
    df = _skewed(spark)
    counts = count_by(df, ["k"])
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    hot = counts.where("k = 0").first()["count"]
    assert hot == 20000
    best = argmax_by_group(count_by(df.withColumn("g", F.lit(1)), ["g", "k"]), "g", "k", "count")
    assert best.first().k == 0


def test_hot_null_key_fill_splits_and_stays_whole(spark):
    # a third of the rows have a null key: they never match a mean, and in a
    # shuffle join they would all hash to one partition
    k = F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 500 + 1)
    df = spark.range(60000).select(k.cast("long").alias("k"),
                                   F.when(F.col("id") % 4 != 0, F.col("id") / 7.0).alias("v"))
    expected = fill_group_mean(df, ["k"], ["v"])
    with conf(spark, SKEW_CONF):
        got = fill_group_mean(df, ["k"], ["v"], max_groups=0)
        rows = got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan, plan
    assert len(rows) == 60000
    nulls = [r.v for r in rows if r.k is None]
    assert len(nulls) == 20000 and sum(v is None for v in nulls) == 5000   # never filled
    assert frames_equal(spark.createDataFrame(rows, got.schema), expected)
