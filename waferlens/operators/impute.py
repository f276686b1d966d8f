"""Exact medians per channel and their use as fill values."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waferlens.operators.ordering import SINGLE_TASK_ROWS, running_sum
from waferlens.operators.quality import BROADCAST_CHANNELS, join_channels
from waferlens.shared import materialise, stage_table

# The built-in median holds a channel's distinct values in one task's memory.
IN_MEMORY_VALUES = 100_000
# Values a quantile sketch keeps of a channel, and the share of ranks on each side of the
# middle that its bracket takes: more than its error in 99 of 100 cases.
SKETCH_VALUES, BRACKET = 400, 0.01
# Up to this many channels are sketched; a sketch is some kilobytes for each channel and task.
SKETCHED_CHANNELS = 10_000
# Bins a channel's range is cut into, and how often the bin around the median is cut again.
BINS = 256
NARROWINGS = 4


def value_spread(
    readings: DataFrame, sensor: str = "sensor_id", reading: str = "reading_value"
) -> DataFrame:
    """Count, mean and spread per channel, as ``channel_median`` uses them."""
    return readings.groupBy(sensor).agg(
        F.count(reading).alias("non_null_readings"),
        F.avg(reading).alias("reading_mean"),
        F.stddev_samp(reading).alias("reading_stddev"),
    )


def channel_median(
    readings: DataFrame,
    sensor: str = "sensor_id",
    reading: str = "reading_value",
    name: str = "sensor_median",
    spread: DataFrame | None = None,
    in_memory_values: int = IN_MEMORY_VALUES,
    single_task_rows: int = SINGLE_TASK_ROWS,
    sketched_channels: int = SKETCHED_CHANNELS,
) -> DataFrame:
    """Exact interpolating median of the non-null readings of every channel.

    ``spread`` takes the ``value_spread`` columns of an earlier profile, which
    saves a scan; only its channels are computed. Where channels are small the
    built-in median does it; otherwise the median is bracketed by a sketch, or
    by counts where there are too many channels, so a channel of any size is
    spread over all tasks.
    """
    given = spread is not None
    if not given:
        spread = materialise(value_spread(readings, sensor, reading))
    sizes = spread.agg(F.max("non_null_readings"), F.count(F.lit(1))).first()
    if (sizes[0] or 0) <= in_memory_values:
        if given:
            wanted = spread.select(sensor)
            if sizes[1] <= BROADCAST_CHANNELS:
                wanted = F.broadcast(wanted)
            readings = readings.join(wanted, sensor, "left_semi")
        return readings.groupBy(sensor).agg(F.median(reading).alias(name))
    if sizes[1] <= sketched_channels:
        return sketched_median(readings, sensor, reading, name, spread, single_task_rows)
    return counted_median(readings, spread, sensor, reading, name, single_task_rows)


def _copied(readings: DataFrame, wanted: DataFrame | None, sensor: str, reading: str) -> DataFrame:
    """Channel and value of the wanted channels, written out once and read instead of the table."""
    values = readings.select(sensor, F.col(reading).cast("double").alias("_value"))
    if wanted is not None:
        few = wanted.count() <= BROADCAST_CHANNELS
        values = values.join(F.broadcast(wanted) if few else wanted, sensor, "left_semi")
    return stage_table(values, "channel-values")


def sketched_median(
    readings: DataFrame,
    sensor: str = "sensor_id",
    reading: str = "reading_value",
    name: str = "sensor_median",
    wanted: DataFrame | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Exact median of channels of any size: a sketch says where to look, counts decide.

    The table is read once, to copy channel and value. One pass over the copy
    gives each channel's size and a bracket around its middle, from a quantile
    sketch that combines map-side. A second pass counts the values below the
    bracket, and those in it one by one; the middle ranks are looked up in the
    running counts. A channel whose middle was not in its bracket, or that holds
    NaN, goes to ``counted_median``: a poor sketch costs passes, never exactness.
    """
    channels = None if wanted is None else wanted.select(sensor)
    copy = _copied(readings, channels, sensor, reading)
    sketch = F.kll_sketch_agg_double("_value", F.lit(SKETCH_VALUES))
    sketched = copy.groupBy(sensor).agg(
        F.count("_value").alias("_rows"),
        F.count(F.when(F.isnan("_value"), 1)).alias("_nans"),
        sketch.alias("_sketch"),
    )
    at = lambda rank: F.kll_sketch_get_quantile_double("_sketch", F.lit(rank))
    usable = (F.col("_rows") > 0) & (F.col("_nans") == 0)
    state = materialise(
        sketched.select(
            sensor,
            "_rows",
            F.floor((F.col("_rows") + 1) / 2).alias("_lower_rank"),
            F.floor((F.col("_rows") + 2) / 2).alias("_upper_rank"),
            F.lit(0).cast("long").alias("_before"),
            F.when(usable, at(0.5 - BRACKET)).alias("_from"),
            F.when(usable, at(0.5 + BRACKET)).alias("_to"),
        )
    )
    few = state.count() <= BROADCAST_CHANNELS
    bounds = state.select(sensor, "_from", "_to")
    placed = copy.join(F.broadcast(bounds) if few else bounds, sensor).where(
        F.col("_value") <= F.col("_to")
    )
    # All values below the bracket are one row, which comes first.
    inside = F.when(F.col("_value") >= F.col("_from"), F.col("_value"))
    counted = placed.groupBy(sensor, inside.alias("_value")).agg(F.count(F.lit(1)).alias("_times"))
    found = materialise(_looked_up(counted, state, sensor, name, single_task_rows))
    missed = state.join(found.where(F.col(name).isNull()), sensor, "left_semi").where("_rows > 0")
    if missed.isEmpty():
        return found
    missed = missed.select(sensor)
    again = copy.join(F.broadcast(missed) if few else missed, sensor, "left_semi")
    spread = materialise(value_spread(again, sensor, "_value"))
    counts = counted_median(again, spread, sensor, "_value", name, single_task_rows)
    return found.join(missed, sensor, "left_anti").unionByName(counts)


def counted_median(
    readings: DataFrame,
    spread: DataFrame,
    sensor: str = "sensor_id",
    reading: str = "reading_value",
    name: str = "sensor_median",
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Exact median of channels too large for one task, by counts alone.

    A median lies within one standard deviation of the mean. That range is cut
    into bins, readings are counted per bin, and the bins of the middle ranks
    become the next, narrower range; any bin, the two outside the range
    included, carries its own extremes, so a poor first guess costs a pass but
    never exactness. Readings of the last range are counted by value, and the
    middle ranks are looked up in running counts. Every step combines map-side.

    The readings of the wanted channels are written out once, as channel and
    value; all passes after that read this copy and not the whole table.
    """
    values = _copied(readings.where(F.col(reading).isNotNull()), spread.select(sensor), sensor, reading)
    spare = F.coalesce("reading_stddev", F.lit(0.0))
    state = materialise(
        spread.select(
            sensor,
            F.floor((F.col("non_null_readings") + 1) / 2).alias("_lower_rank"),
            F.floor((F.col("non_null_readings") + 2) / 2).alias("_upper_rank"),
            # Everything is inside at first; NaN is above every other double.
            F.lit(-math.inf).alias("_from"),
            F.lit(math.nan).alias("_to"),
            (F.col("reading_mean") - spare).alias("_low"),
            (F.col("reading_mean") + spare).alias("_high"),
            F.lit(0).cast("long").alias("_before"),
            F.col("non_null_readings").alias("_inside"),
        )
    )
    few_channels = state.count() <= BROADCAST_CHANNELS

    def inside(current: DataFrame) -> DataFrame:
        bounds = current.select(sensor, "_from", "_to", "_low", "_high")
        joined = values.join(F.broadcast(bounds) if few_channels else bounds, sensor)
        return joined.where(F.col("_value").between(F.col("_from"), F.col("_to")))

    for _ in range(NARROWINGS):
        open_ranges = state.where(F.col("_from") < F.col("_to"))
        if (open_ranges.agg(F.sum("_inside")).first()[0] or 0) <= single_task_rows:
            break
        state = materialise(_narrowed(inside(state), state, sensor))

    counted = inside(state).groupBy(sensor, "_value").agg(F.count(F.lit(1)).alias("_times"))
    return _looked_up(counted, state, sensor, name, single_task_rows)


def _looked_up(
    counted: DataFrame, state: DataFrame, sensor: str, name: str, single_task_rows: int
) -> DataFrame:
    """The median of each channel of ``state``: the values at its middle ranks.

    ``counted`` holds how often a value occurs, from the rank after ``_before``
    on; NULL if the ranks are not there.
    """
    upto = running_sum(counted, [sensor, "_value"], "_times", "_upto", single_task_rows)
    start = upto.groupBy(sensor).agg(
        F.min(F.col("_upto") - F.col("_times")).alias("_start")
    )
    ranks = state.join(start, sensor, "left").select(
        sensor,
        (F.col("_start") + F.col("_lower_rank") - F.col("_before")).alias("_lower"),
        (F.col("_start") + F.col("_upper_rank") - F.col("_before")).alias("_upper"),
    )
    at_lower, at_upper = _holds("_lower"), _holds("_upper")
    picked = (
        upto.join(ranks, sensor)
        .where(at_lower | at_upper)
        .groupBy(sensor)
        .agg(
            F.max(F.when(at_lower, F.col("_value"))).alias("_left"),
            F.max(F.when(at_upper, F.col("_value"))).alias("_right"),
        )
    )
    return ranks.join(picked, sensor, "left").select(
        # Halved first, as the sum of two large readings is no double; equal ones stay exact.
        sensor,
        F.when(F.col("_left") == F.col("_right"), F.col("_left"))
        .otherwise(F.col("_left") * 0.5 + F.col("_right") * 0.5)
        .alias(name),
    )


def _holds(rank: str):
    """Whether ``_times`` rows ending at running count ``_upto`` include a rank."""
    return (F.col(rank) > F.col("_upto") - F.col("_times")) & (F.col(rank) <= F.col("_upto"))


def _narrowed(inside: DataFrame, state: DataFrame, sensor: str) -> DataFrame:
    """The state with each range cut down to the bins that hold the middle ranks."""
    width = F.col("_high") - F.col("_low")
    place = F.floor((F.col("_value") - F.col("_low")) / width * BINS)
    in_bin = (
        F.when(F.col("_value") < F.col("_low"), F.lit(-1))
        .when(F.col("_value") > F.col("_high"), F.lit(BINS))
        .when((width > 0) & (width < math.inf), F.least(place, F.lit(BINS - 1)))
        .otherwise(F.lit(0))
    )
    # At most BINS + 2 rows per channel, whatever its size.
    by_bin = Window.partitionBy(sensor).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    bins = (
        inside.groupBy(sensor, in_bin.cast("int").alias("_bin"))
        .agg(
            F.count(F.lit(1)).alias("_times"),
            F.min("_value").alias("_least"),
            F.max("_value").alias("_most"),
        )
        .withColumn("_upto", F.sum("_times").over(by_bin))
        .join(state.select(sensor, "_lower_rank", "_upper_rank", "_before"), sensor)
        .withColumn("_upto", F.col("_upto") + F.col("_before"))
    )
    found = (
        bins.where(_holds("_lower_rank") | _holds("_upper_rank"))
        .groupBy(sensor)
        .agg(
            F.min("_least").alias("_from"),
            F.max("_most").alias("_to"),
            F.min(F.col("_upto") - F.col("_times")).alias("_before"),
            F.sum("_times").alias("_inside"),
        )
    )
    ranks = state.select(sensor, "_lower_rank", "_upper_rank")
    return ranks.join(found, sensor, "left").select(
        sensor,
        "_lower_rank",
        "_upper_rank",
        "_from",
        "_to",
        F.col("_from").alias("_low"),
        F.col("_to").alias("_high"),
        "_before",
        "_inside",
    )


def fill_channels(
    quality: DataFrame,
    staged: DataFrame,
    sensor: str = "sensor_id",
    reading: str = "reading_value",
) -> DataFrame:
    """Selected channels with rank and median: the one small table features need.

    Fixed once, so imputation and pivoting do not recompute the medians.
    """
    selected = quality.where("is_selected_for_ml")
    medians = channel_median(staged, sensor, reading, spread=selected)
    return materialise(
        selected.select(sensor, "sensor_rank").join(medians, sensor, "left")
    )


def median_impute(
    staged: DataFrame,
    fills: DataFrame,
    wafer: str = "wafer_id",
    sensor: str = "sensor_id",
    reading: str = "reading_value",
    keep_rank: bool = False,
) -> DataFrame:
    """Readings of the selected channels with NULL replaced by the channel median.

    Selecting, adding the median and adding the rank are one join, map-side
    while ``fills``, a fixed table, is small.
    A channel without any reading has no median and stays NULL.
    """
    joined = join_channels(staged.select(wafer, sensor, reading), fills, sensor)
    return joined.select(
        wafer,
        sensor,
        F.coalesce(reading, "sensor_median").alias(reading),
        F.col(reading).isNull().alias("was_imputed"),
        *(["sensor_rank"] if keep_rank else []),
    )
