"""One feature row per wafer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waferlens.config import PipelineConfig
from waferlens.functions.columns import clean_reading


def wafer_features(
    imputed: DataFrame,
    config: PipelineConfig = PipelineConfig(),
    wafer: str = "wafer_id",
    reading: str = "reading_value",
) -> DataFrame:
    """Pivot ranked, imputed readings into ``feature_NNN`` columns.

    One aggregation with plain maxima: a wafer's readings are folded map-side,
    so what is shuffled is about one feature row per wafer.
    """
    imputed_flag = F.col("was_imputed").cast("int")
    return imputed.groupBy(wafer).agg(
        F.max(imputed_flag).alias("any_imputed_flag"),
        F.sum(imputed_flag).alias("imputed_sensor_count"),
        *[
            F.max(F.when(F.col("sensor_rank") == rank, F.col(reading))).alias(feature)
            for rank, feature in enumerate(config.feature_names, start=1)
        ],
    )


def wafer_features_wide(
    matrix: DataFrame,
    fills: DataFrame,
    config: PipelineConfig = PipelineConfig(),
    wafer: str = "wafer_id",
    values: str = "values",
    sensor: str = "sensor_id",
) -> DataFrame:
    """The same features straight from one raw array per wafer, without any shuffle.

    The arrays hold every channel, as ``read_matrix`` leaves them. The selected
    channels (at most ``top_sensors`` rows) become literal arrays, so the work
    per wafer is a short loop however many features there are.
    """
    chosen = fills.orderBy("sensor_rank").select(sensor, "sensor_median").collect()
    channels = F.array(*[F.lit(row[sensor]) for row in chosen])
    medians = F.array(*[F.lit(row["sensor_median"]).cast("double") for row in chosen])
    picked = matrix.select(
        wafer,
        F.transform(
            channels, lambda c: clean_reading(F.get(F.col(values), c - 1), config.sentinel)
        ).alias("_picked"),
    )
    filled = picked.select(
        wafer,
        F.size(F.filter("_picked", lambda reading: reading.isNull())).alias("_gaps"),
        F.zip_with("_picked", medians, lambda r, m: F.coalesce(r, m)).alias("_filled"),
    )
    return filled.select(
        wafer,
        (F.col("_gaps") > 0).cast("int").alias("any_imputed_flag"),
        F.col("_gaps").cast("long").alias("imputed_sensor_count"),
        *[
            F.get("_filled", F.lit(place)).alias(feature)
            for place, feature in enumerate(config.feature_names)
        ],
    )


def ml_features(
    features: DataFrame,
    labels: DataFrame,
    config: PipelineConfig = PipelineConfig(),
    wafer: str = "wafer_id",
    built_at: Column | None = None,
) -> DataFrame:
    """Feature rows joined to staged labels; wafers without a label drop out."""
    joined = features.join(
        labels.select(wafer, "yield_status", "is_fail", "tested_at"), wafer, "inner"
    )
    return joined.select(
        wafer,
        "yield_status",
        "is_fail",
        "tested_at",
        F.col("tested_at").cast("date").alias("test_date"),
        "any_imputed_flag",
        "imputed_sensor_count",
        *config.feature_names,
        (built_at if built_at is not None else F.current_timestamp()).alias(
            "feature_set_built_at"
        ),
    )
