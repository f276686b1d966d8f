"""Wide to long."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def melt_array(
    df: DataFrame,
    wafer: str = "wafer_id",
    values: str = "values",
    sensor: str = "sensor_id",
    reading: str = "reading_value",
) -> DataFrame:
    """One row per array element, missing readings included; channels count from 1."""
    return df.select(wafer, F.posexplode(values).alias("_position", reading)).select(
        wafer, (F.col("_position") + 1).alias(sensor), reading
    )


def melt_columns(
    df: DataFrame,
    wafer: str = "wafer_id",
    sensor: str = "sensor_id",
    reading: str = "reading_value",
    prefix: str = "sensor_",
) -> DataFrame:
    """One row per (wafer, ``<prefix>NNN`` column), missing readings included."""
    channels = [c for c in df.columns if c.startswith(prefix)]
    long = df.select(wafer, *[F.col(c).cast("double").alias(c) for c in channels]).unpivot(
        [wafer], channels, "_name", reading
    )
    return long.select(
        wafer, F.replace("_name", F.lit(prefix), F.lit("")).cast("int").alias(sensor), reading
    )
