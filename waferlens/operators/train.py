"""Stratified split, class weights, random forest, scoring, importances."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.classification import (
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waferlens.config import FEATURE_PREFIX
from waferlens.functions.columns import map_label
from waferlens.operators.impute import channel_median
from waferlens.operators.ordering import global_rank
from waferlens.shared import materialise

# The recorded training setup.
TEST_FRACTION = 0.2
SEED = 42
TREES = 300
DEPTH = 12
TOP_FEATURES = 10

# 16**4 hash buckets: few enough to count map-side, and the one that holds the split
# point has a 65,536th of a class.
HASH_DIGITS = 4
# Up to this many classes their thresholds are broadcast; more are joined by shuffle.
BROADCAST_CLASSES = 10_000
# Training rows a task holds; small enough to cache, whatever the number of rows. Rows
# below that many partitions are spread all the same. Both fix the draws of the forest.
ROWS_PER_PARTITION = 500_000
PARTITIONS = 32
# Class weights are multiples of this, so that sums of them are exact in any order.
WEIGHT_STEP = 2.0**-24


def feature_columns(df: DataFrame, prefix: str = FEATURE_PREFIX) -> list[str]:
    """The feature columns of a table by rank, however many digits a rank has."""
    ranks = {name: name.removeprefix(prefix) for name in df.columns if name.startswith(prefix)}
    numbered = [(int(rank), name) for name, rank in ranks.items() if rank.isdecimal()]
    return [name for _, name in sorted(numbered)]


def with_target(df: DataFrame, target: str = "is_fail", drop_unlabelled: bool = False) -> DataFrame:
    """Rows fit for training; a missing target is an error unless dropped."""
    if drop_unlabelled:
        return df.where(F.col(target).isNotNull())
    return df.withColumn(
        target,
        F.coalesce(target, F.raise_error(F.lit(f"{target} is missing")).cast("int")),
    )


def class_counts(df: DataFrame, target: str) -> tuple[DataFrame, int, int]:
    """Rows per class (``class_rows``), computed once; rows of all, and classes."""
    counted = materialise(df.groupBy(target).agg(F.count(F.lit(1)).alias("class_rows")))
    classes, rows = counted.agg(F.count(F.lit(1)), F.sum("class_rows")).first()
    return counted, rows or 0, classes


def _key_digest(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))


def hashed_split(
    df: DataFrame,
    key: str = "wafer_id",
    target: str = "is_fail",
    test_fraction: float | Mapping[object, float] = TEST_FRACTION,
    seed: int = SEED,
    name: str = "split",
) -> DataFrame:
    """Add ``name`` (train/test) by a threshold on the seeded hash of the key alone.

    One projection: nothing is counted, shuffled or run before. A key is always
    on the same side, however many rows are added, and the sizes are those
    wanted but for chance, overall and per class. ``test_fraction`` may give
    each class a share of its own (0 for classes it lacks). Rows without a
    target are in neither set, those without a key in the training set.
    """
    shares = test_fraction if isinstance(test_fraction, Mapping) else None
    share = F.lit(float(test_fraction)) if shares is None else map_label(F.col(target), shares, 0.0)
    place = F.conv(F.substring(_key_digest(key, seed), 1, 8), 16, 10).cast("long")
    in_test = place < F.round(share * 2**32)
    side = F.when(in_test, F.lit("test")).otherwise(F.lit("train"))
    return df.withColumn(name, F.when(F.col(target).isNotNull(), side))


def stratified_split(
    df: DataFrame,
    key: str = "wafer_id",
    target: str = "is_fail",
    test_fraction: float = TEST_FRACTION,
    seed: int = SEED,
    name: str = "split",
    exact: bool = True,
) -> DataFrame:
    """Add ``name`` (train/test) with exact sizes overall and per class, for unique keys.

    The test set has ``ceil(n * test_fraction)`` rows, shared out to classes by
    largest remainder. Within a class the rows with the smallest seeded key
    hashes are taken. The hash that separates the two sets is found from bucket
    counts and one small bucket per class; assigning rows is then a map-side
    comparison, so no class is ever sorted. Rows without a target are in
    neither set and count for none: their ``name`` is NULL.

    Unless ``exact``, this is ``hashed_split``, without any job before.
    """
    if not exact:
        return hashed_split(df, key, target, test_fraction, seed, name)
    digest = _key_digest(key, seed)
    labelled = df.select(key, target).where(F.col(target).isNotNull())
    hashed = labelled.withColumn("_hash", digest)
    bucket = F.substring("_hash", 1, HASH_DIGITS)
    counted = materialise(
        hashed.groupBy(target, bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_rows"))
    )
    sizes = materialise(counted.groupBy(target).agg(F.sum("_rows").alias("class_rows")))
    classes, rows = sizes.agg(F.count(F.lit(1)), F.sum("class_rows")).first()
    test_rows = math.ceil((rows or 0) * test_fraction)
    share = F.col("class_rows") * F.lit(test_rows) / F.lit(max(rows or 0, 1))
    least = sizes.withColumn("_floor", F.floor(share)).withColumn("_rest", share - F.col("_floor"))
    spare = test_rows - (least.agg(F.sum("_floor")).first()[0] or 0)
    placed = global_rank(least, [F.col("_rest").desc(), F.col(target)], "_place")
    quotas = placed.select(
        target, (F.col("_floor") + (F.col("_place") <= spare).cast("int")).alias("_quota")
    )
    bounded = F.broadcast if classes <= BROADCAST_CLASSES else lambda side: side
    in_class = Window.partitionBy(target).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, 0
    )
    borders = (
        counted.withColumn("_upto", F.sum("_rows").over(in_class))
        .join(bounded(quotas), target)
        .where(
            (F.col("_upto") - F.col("_rows") < F.col("_quota"))
            & (F.col("_quota") <= F.col("_upto"))
        )
        .select(
            target,
            "_bucket",
            (F.col("_quota") - F.col("_upto") + F.col("_rows")).alias("_take"),
        )
    )
    in_border = (
        Window.partitionBy(target)
        .orderBy("_hash", key)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    # One row per class, fixed so that later uses of the split do not search again.
    # Rows are counted per key first, so a repeated key weighs nothing and stays together.
    thresholds = materialise(
        hashed.withColumn("_bucket", bucket)
        .join(bounded(borders), [target, "_bucket"])
        .groupBy(target, "_hash", key, "_take")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_upto", F.sum("_rows").over(in_border))
        .where((F.col("_upto") >= F.col("_take")) & (F.col("_upto") - F.col("_rows") < F.col("_take")))
        .select(target, F.col("_hash").alias("_last_hash"), F.col(key).alias("_last_key"))
    )
    in_test = (F.col("_hash") < F.col("_last_hash")) | (
        (F.col("_hash") == F.col("_last_hash")) & (F.col(key) <= F.col("_last_key"))
    )
    return (
        df.withColumn("_hash", digest)
        .join(bounded(thresholds), target, "left")
        .withColumn(
            name,
            F.when(in_test, F.lit("test")).when(F.col(target).isNotNull(), F.lit("train")),
        )
        .select(*df.columns, name)
    )


def class_weights(df: DataFrame, target: str = "is_fail") -> DataFrame:
    """(target, class_rows, class_weight) with ``rows / (classes * class rows)``."""
    counted, rows, classes = class_counts(df, target)
    weight = F.lit(rows) / (F.lit(classes) * F.col("class_rows"))
    return counted.select(target, "class_rows", weight.alias("class_weight"))


def fill_values(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """For every feature with gaps the median of its values, 0.0 where it has none.

    Only features with gaps are looked at again, as rows of (feature, value).
    """
    if not features:
        return {}
    gap = lambda name: F.col(name).isNull() | F.isnan(name)
    missing = df.agg(*(F.count(F.when(gap(name), 1)).alias(name) for name in features)).first()
    gaps = [name for name in features if missing[name]]
    if not gaps:
        return {}
    cells = [
        F.struct(F.lit(name).alias("sensor_id"), F.col(name).cast("double").alias("value"))
        for name in gaps
    ]
    long = df.select(F.inline(F.array(*cells))).select(
        "sensor_id", F.when(~F.isnan("value"), F.col("value")).alias("reading_value")
    )
    found = {row["sensor_id"]: row["sensor_median"] for row in channel_median(long).collect()}
    return {name: 0.0 if found.get(name) is None else found[name] for name in gaps}


def assemble(
    df: DataFrame, features: Sequence[str], fills: Mapping[str, float] | None = None
) -> DataFrame:
    """Add the feature vector, gaps filled with the feature's own value of ``fills``.

    A gap in a feature that had none in training is an error.
    """
    fills = fills or {}
    filled = df.withColumns(
        {
            name: F.coalesce(F.when(~F.isnan(name), F.col(name)), F.lit(fills[name]))
            for name in features
            if name in fills
        }
    )
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(filled)


def train_forest(
    train: DataFrame,
    features: Sequence[str],
    target: str = "is_fail",
    trees: int = TREES,
    depth: int = DEPTH,
    seed: int = SEED,
    fills: Mapping[str, float] | None = None,
    partitions: int = PARTITIONS,
) -> RandomForestClassificationModel:
    """Class-balanced random forest, grown level by level over all executors.

    Every level passes over the rows for all trees, so the rows are spread
    evenly once, however few files they come from. Their partitions depend on
    the rows alone, and class weights are rounded to binary fractions, whose
    sums are exact: the same rows and seed give the same trees on any cluster.

    The node a row has reached in each tree is kept from level to level (four
    bytes a row and tree, in memory or on disk), so a level neither walks each
    row down from the root nor sends the trees grown so far to every task.
    """
    weights = materialise(class_weights(train, target))
    classes, rows = weights.agg(F.count(F.lit(1)), F.sum("class_rows")).first()
    rounded = F.round(F.col("class_weight") / WEIGHT_STEP) * WEIGHT_STEP
    weights = weights.select(target, F.greatest(rounded, F.lit(WEIGHT_STEP)).alias("class_weight"))
    weighted = train.select(target, *features).join(
        F.broadcast(weights) if classes <= BROADCAST_CLASSES else weights, target
    )
    forest = RandomForestClassifier(
        labelCol=target,
        featuresCol="features",
        weightCol="class_weight",
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
        maxMemoryInMB=1024,
        cacheNodeIds=True,
    )
    count = max(partitions, math.ceil((rows or 0) / ROWS_PER_PARTITION))
    every = [target, *features]
    spread = weighted.repartition(count, F.xxhash64(*every)).sortWithinPartitions(*every)
    return forest.fit(assemble(spread, features, fills))


def score_batch(
    model: RandomForestClassificationModel,
    df: DataFrame,
    features: Sequence[str],
    fills: Mapping[str, float] | None = None,
) -> DataFrame:
    """Add the predicted class and the probability of the positive class."""
    scored = model.transform(assemble(df, features, fills))
    return scored.select(
        *df.columns,
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("score"),
    )


def top_features(
    spark: SparkSession,
    model: RandomForestClassificationModel,
    features: Sequence[str],
    count: int = TOP_FEATURES,
) -> DataFrame:
    """The most important features, ties in feature order."""
    rows = list(zip(features, model.featureImportances.toArray().tolist(), strict=True))
    return (
        spark.createDataFrame(rows, "feature string, importance double")
        .orderBy(F.desc("importance"), "feature")
        .limit(count)
    )


def save_model(model: RandomForestClassificationModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> RandomForestClassificationModel:
    return RandomForestClassificationModel.load(path)


def save_inputs(
    spark: SparkSession, path: str, features: Sequence[str], fills: Mapping[str, float]
) -> None:
    """What a model needs besides its trees: its features in order, and their fill values."""
    rows = [(place, name, fills.get(name)) for place, name in enumerate(features)]
    inputs = spark.createDataFrame(rows, "place int, feature string, fill double")
    inputs.coalesce(1).write.mode("overwrite").parquet(path)


def load_inputs(spark: SparkSession, path: str) -> tuple[list[str], dict[str, float]]:
    rows = sorted(spark.read.parquet(path).collect(), key=lambda row: row["place"])
    fills = {row["feature"]: row["fill"] for row in rows if row["fill"] is not None}
    return [row["feature"] for row in rows], fills
