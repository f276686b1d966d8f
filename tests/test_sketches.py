"""Distinct counts, medians and splits by sketches and hashes."""

import random

import pytest
from pyspark.sql import functions as F

from waferlens.operators import impute, sketches, train
from waferlens.sources import tables


@pytest.mark.parametrize("distinct", [0, 1, 900, 60_000])
def test_estimates_stay_within_the_bound_and_merge_to_one_pass(spark, distinct):
    rows = spark.range(max(1, distinct) * 3).select(
        F.when(F.lit(distinct) > 0, F.col("id") % max(1, distinct)).alias("value"),
        (F.col("id") % 7).alias("day"),
        (F.col("id") % 3).alias("shop"),
    )
    fine = sketches.distinct_sketches(rows, "value", ["day", "shop"])
    merged = sketches.merge_sketches(sketches.merge_sketches(fine, ["day"]))
    once = sketches.distinct_sketches(rows.repartition(1), "value")
    counts = [s.select(sketches.distinct_estimate()).first()[0] for s in (merged, once)]
    assert counts[0] == counts[1]
    assert abs(counts[0] - distinct) <= sketches.error_bound() * distinct


def test_a_day_that_comes_again_replaces_its_own_sketch(spark, tmp_path):
    path = str(tmp_path / "sketches")
    frame = lambda rows: spark.createDataFrame(rows, "day int, value double")
    load = lambda rows: sketches.store_sketches(
        sketches.distinct_sketches(frame(rows), "value", ["day"]), path, "day"
    )
    load([(1, 0.5), (1, 1.5), (2, 0.5), (2, None)])
    load([(2, 7.0), (2, 8.0), (2, 9.0)])
    found = spark.read.parquet(path).select("day", sketches.distinct_estimate())
    assert {tuple(r) for r in found.collect()} == {(1, 2), (2, 3)}
    total = sketches.merge_sketches(spark.read.parquet(path)).select(sketches.distinct_estimate())
    assert total.first()[0] == 5


def test_audit_counts_channels_by_a_sketch_on_request(spark):
    long = spark.range(50_000).select((F.col("id") % 5_000).alias("sensor_id"))
    exact, near = (tables.ingest_audit(long, long, exact=e).first() for e in (True, False))
    assert exact["sensor_count"] == 5_000 and exact["reading_count"] == near["reading_count"] == 50_000
    assert abs(near["sensor_count"] - 5_000) < 3 * tables.CHANNEL_COUNT_ERROR * 5_000


def tailed_channels():
    """Heavy tails, constants, two far halves, ties, gaps, one value, none, infinities, NaN."""
    rng = random.Random(4)
    channels = {
        "pareto": [rng.paretovariate(0.4) for _ in range(5_000)],
        "cauchy": [rng.gauss(0, 1) / (rng.gauss(0, 1) or 1) for _ in range(5_001)],
        "huge": [rng.choice([-1e308, 1e308]) for _ in range(1_000)],
        "constant": [3.5] * 4_000,
        "halves": [0.0] * 1_000 + [1e9] * 1_000,
        "ties": [float(rng.randrange(3)) for _ in range(3_001)],
        "gaps": [rng.choice([None, rng.random()]) for _ in range(2_000)],
        "one": [-7.25],
        "two": [1.0, 2.0],
        "none": [None, None],
        "infinite": [float("inf")] * 30 + [float("-inf")] * 30 + [0.0, -0.0, 1.0],
    }
    return {k: rng.sample(v, len(v)) for k, v in channels.items()}


def exact_median(values):
    ordered = sorted(v for v in values if v is not None)
    if not ordered:
        return None
    left, right = ordered[(len(ordered) - 1) // 2], ordered[len(ordered) // 2]
    return left if left == right else left * 0.5 + right * 0.5


@pytest.fixture(scope="module")
def tailed(spark):
    rows = [(k, v) for k, values in tailed_channels().items() for v in values]
    return spark.createDataFrame(rows, "sensor_id string, reading_value double").repartition(6)


@pytest.mark.parametrize("single_task_rows", [1_000_000, 10])
@pytest.mark.parametrize("values, bracket", [(400, 0.01), (8, 0.01)])
def test_sketched_median_is_exact_whatever_the_sketch(spark, tailed, monkeypatch, single_task_rows, values, bracket):
    monkeypatch.setattr(impute, "SKETCH_VALUES", values)
    monkeypatch.setattr(impute, "BRACKET", bracket)
    found = impute.sketched_median(tailed, name="m", single_task_rows=single_task_rows)
    expected = {k: exact_median(v) for k, v in tailed_channels().items()}
    assert {r["sensor_id"]: r["m"] for r in found.collect()} == expected


def test_channels_with_nan_or_a_missed_bracket_are_counted(spark, monkeypatch):
    rows = [("n", float("nan"))] * 3 + [("n", 1.0), ("n", 2.0)] + [("v", float(i)) for i in range(5)]
    df = spark.createDataFrame(rows, "sensor_id string, reading_value double")
    found = {r[0]: repr(r[1]) for r in impute.sketched_median(df, name="m").collect()}
    assert found == {"n": "nan", "v": "2.0"}
    monkeypatch.setattr(impute, "BRACKET", -0.4)
    turned = {r[0]: repr(r[1]) for r in impute.sketched_median(df, name="m").collect()}
    assert turned == found


def test_sketched_median_reads_the_table_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    df = spark.range(20_000).selectExpr("id % 4 as sensor_id", "cast(id * 17 % 1009 as double) as reading_value")
    impute.sketched_median(df.mapInPandas(counted, df.schema), single_task_rows=100).collect()
    assert reads.value == 20_000


def test_large_channels_go_by_sketch_and_too_many_by_counts(spark, tailed):
    expected = {k: exact_median(v) for k, v in tailed_channels().items()}
    for most in (100, 0):
        found = impute.channel_median(tailed, name="m", in_memory_values=0, sketched_channels=most)
        assert {r["sensor_id"]: r["m"] for r in found.collect()} == expected


def test_hashed_split_is_a_projection_and_stable(spark):
    df = spark.range(20_000).selectExpr("id as wafer_id", "cast(id % 10 = 0 as int) as is_fail")
    split = train.stratified_split(df, exact=False)
    assert "Exchange" not in split._jdf.queryExecution().toString()
    shares = split.groupBy("is_fail").agg(F.avg((F.col("split") == "test").cast("int"))).collect()
    assert all(abs(share - 0.2) < 0.04 for _, share in shares)
    some = train.hashed_split(df.where("wafer_id % 7 = 3").union(df.where("wafer_id = 3")))
    sides = some.join(split.withColumnRenamed("split", "whole"), "wafer_id")
    assert sides.where("split <> whole").isEmpty()
    assert train.hashed_split(df, seed=1).join(split.withColumnRenamed("split", "s"), "wafer_id").where("split <> s").count() > 4_000


def test_hashed_split_of_odd_rows_and_own_shares(spark):
    rows = [(1, None), (None, 1), (None, 0), *((i, i % 2) for i in range(2_000))]
    df = spark.createDataFrame(rows, "wafer_id long, is_fail int")
    split = train.hashed_split(df, test_fraction={1: 0.5})
    counts = {tuple(r[:2]): r[2] for r in split.groupBy("is_fail", "split").count().collect()}
    assert counts[None, None] == 1
    assert (0, "test") not in counts and 400 < counts[1, "test"] < 600
    assert {r["split"] for r in split.where("wafer_id is null").collect()} == {"train"}
