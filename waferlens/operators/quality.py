"""Channel cleaning, profiling, ranking and selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waferlens.config import PipelineConfig
from waferlens.functions.columns import clean_reading, is_sentinel, percentage
from waferlens.operators.joins import bounded_join
from waferlens.operators.ordering import SINGLE_TASK_ROWS, global_rank
from waferlens.shared import materialise

# A channel list longer than this is joined by shuffle instead of broadcast.
BROADCAST_CHANNELS = 100_000


def stage_readings(
    readings: DataFrame,
    config: PipelineConfig = PipelineConfig(),
    wafer: str = "wafer_id",
    sensor: str = "sensor_id",
    reading: str = "reading_value",
) -> DataFrame:
    """Long readings with missing values as NULL and a flag for the sentinel."""
    return readings.select(
        wafer,
        sensor,
        clean_reading(F.col(reading), config.sentinel).alias(reading),
        is_sentinel(F.col(reading), config.sentinel).alias("is_imputed_source_missing"),
    )


def channel_profile(
    staged: DataFrame, sensor: str = "sensor_id", reading: str = "reading_value"
) -> DataFrame:
    """Counts, null share, spread and mean per channel; combined map-side."""
    total = F.count(F.lit(1))
    present = F.count(reading)
    return staged.groupBy(sensor).agg(
        total.alias("total_readings"),
        present.alias("non_null_readings"),
        (total - present).alias("null_readings"),
        percentage(total - present, total).alias("null_pct"),
        F.stddev_samp(reading).alias("reading_stddev"),
        F.avg(reading).alias("reading_mean"),
    )


def rank_channels(
    profile: DataFrame,
    config: PipelineConfig = PipelineConfig(),
    sensor: str = "sensor_id",
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Rank profiled channels by spread, those over the null limit last.

    The limit is compared with the rounded percentage. Channels over it are
    ranked last, not dropped, unless ``strict_null_filter`` is set. The profile
    is fixed once before ranking, so every later use sees the same ranks.
    """
    over_limit = (F.col("null_pct") > F.lit(config.max_null_fraction * 100)).cast("int")
    ranked = global_rank(
        profile,
        [over_limit, F.col("reading_stddev").desc_nulls_last(), F.col(sensor)],
        "sensor_rank",
        single_task_rows,
    )
    selected = F.col("sensor_rank") <= config.top_sensors
    if config.strict_null_filter:
        selected = selected & (over_limit == 0)
    ranked = ranked.withColumn("sensor_rank", F.col("sensor_rank").cast("int"))
    return ranked.withColumn("is_selected_for_ml", selected)


def channel_quality(
    staged: DataFrame,
    config: PipelineConfig = PipelineConfig(),
    sensor: str = "sensor_id",
    reading: str = "reading_value",
) -> DataFrame:
    return rank_channels(channel_profile(staged, sensor, reading), config, sensor)


def selected_channels(quality: DataFrame) -> DataFrame:
    """The top channels; never more rows than ``config.top_sensors``."""
    return quality.where("is_selected_for_ml")


def join_channels(
    readings: DataFrame,
    channels: DataFrame,
    sensor: str = "sensor_id",
    how: str = "inner",
    most: int = BROADCAST_CHANNELS,
) -> DataFrame:
    """Join readings to a fixed table of channels: map-side while that is counted to be small."""
    return bounded_join(readings, channels, sensor, how, most)


def selected_readings(
    staged: DataFrame, selected: DataFrame, sensor: str = "sensor_id"
) -> DataFrame:
    """Readings of the selected channels only: a semi join, map-side while they are few.

    The channels are computed once, to be counted and joined.
    """
    return join_channels(staged, materialise(selected.select(sensor)), sensor, "left_semi")
