"""Yield KPIs of a stream of labels, one row for each test day once it is closed.

The day is a window of event time. A day is closed when a label has come that
was tested at least ``delay`` after the day's end: its row is then appended,
never to change, and its state is dropped. A label for a closed day is late and
left out. Until then labels may come in any order, from any file. State holds
one row for each open day and task, however many labels there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waferlens.config import PipelineConfig
from waferlens.operators.yields import daily_kpis

# How long after a day's end its labels may still come.
DELAY = "2 days"
DAY = "1 day"


def instant(zoneless: Column) -> Column:
    """A zoneless time as the instant with the same clock in UTC.

    Watermarks are instants and days are cut in UTC, whatever the session's zone is.
    """
    return F.to_timestamp(F.concat(zoneless.cast("string"), F.lit("Z")))


def utc_date(at: Column) -> Column:
    """The date of an instant in UTC."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(at) / 86_400).cast("int"))


def daily_yield_stream(
    staged: DataFrame, config: PipelineConfig = PipelineConfig(), delay: str = DELAY
) -> DataFrame:
    """The rows of the batch ``daily_yield`` for closed days, from a stream of staged labels.

    Untimed labels are left out. The same aggregates as in a batch; only the
    order of days is that of their closing.
    """
    return (
        staged.where(F.col("tested_at").isNotNull())
        .select(instant(F.col("tested_at")).alias("_at"), "is_fail")
        .withWatermark("_at", delay)
        .groupBy(F.window("_at", DAY).alias("_day"))
        .agg(*daily_kpis(config))
        .withColumn("test_date", utc_date(F.col("_day.start")))
        .select("test_date", "wafer_count", "fail_count", "pass_count", "fail_rate_pct", "yield_rate_pct")
    )
