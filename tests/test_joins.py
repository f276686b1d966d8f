"""Joins by size: both sides of the bound give the same, and a hot key is split."""

import pytest
from pyspark.sql import functions as F

from waferlens.operators.joins import SALTS, bounded_join
from waferlens.operators.quality import join_channels
from waferlens.shared import materialise


@pytest.fixture(scope="module")
def sides(spark):
    rows = spark.range(2_000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40).alias("sensor_id"),
        F.col("id").alias("wafer_id"),
        F.lit("mine").alias("_salt"),
    )
    side = materialise(spark.range(0, 30).select(F.col("id").alias("sensor_id"), (F.col("id") * 10).alias("rank")))
    return rows.repartition(4), side


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_both_sides_of_the_bound_join_alike(sides, how):
    rows, side = sides
    few, many = (bounded_join(rows, side, "sensor_id", how, most=most) for most in (30, 29))
    assert few.columns == many.columns
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))
    assert "BroadcastHashJoin" in few._jdf.queryExecution().toString()


def test_beyond_the_bound_a_hot_channel_is_dealt(spark, sides):
    rows, side = sides
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = join_channels(rows.drop("_salt"), side, how="inner", most=0)
        assert "SortMergeJoin" in joined._jdf.queryExecution().toString()
        parts = joined.where("sensor_id = 7").select(F.spark_partition_id()).distinct().count()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert parts > 1 and SALTS > 1
