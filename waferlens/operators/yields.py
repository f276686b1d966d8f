"""Label staging and yield KPIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waferlens.config import UNKNOWN_STATUS, PipelineConfig
from waferlens.functions.columns import map_label, parse_test_time, percentage


def stage_labels(
    labels: DataFrame,
    config: PipelineConfig = PipelineConfig(),
    wafer: str = "wafer_id",
    label: str = "pass_fail_raw",
    timestamp: str = "timestamp_str",
) -> DataFrame:
    """Readable status, binary target and parsed time for every raw label."""
    return labels.select(
        wafer,
        label,
        map_label(F.col(label), config.status_by_label, UNKNOWN_STATUS).alias("yield_status"),
        map_label(F.col(label), config.fail_by_label).cast("int").alias("is_fail"),
        parse_test_time(F.col(timestamp)).alias("tested_at"),
    )


def _tallies(config: PipelineConfig):
    """(tested, failed, passed); an unknown label counts as passed unless excluded."""
    known = F.col("is_fail").isNotNull()
    tested = F.count(F.lit(1)) if config.unknown_as_pass else F.count(F.when(known, F.lit(1)))
    failed = F.sum("is_fail")
    return tested, failed, tested - failed


def daily_kpis(config: PipelineConfig) -> list[Column]:
    """The aggregates of one test day, for batches and streams."""
    tested, failed, passed = _tallies(config)
    return [
        tested.alias("wafer_count"),
        failed.alias("fail_count"),
        passed.alias("pass_count"),
        percentage(failed, tested).alias("fail_rate_pct"),
        percentage(passed, tested).alias("yield_rate_pct"),
    ]


def daily_yield(
    staged: DataFrame, config: PipelineConfig = PipelineConfig(), stored: bool = False
) -> DataFrame:
    """Yield KPIs per test date, in date order; untimed labels are left out.

    Of ``stored`` labels the untimed are left out at the scan. Otherwise their
    group is dropped after counting, as a filter would parse each time twice.
    """
    if stored:
        staged = staged.where(F.col("tested_at").isNotNull())
    return (
        staged.select(F.col("tested_at").cast("date").alias("test_date"), "is_fail")
        .groupBy("test_date")
        .agg(
            F.count("test_date").alias("_timed"),
            *daily_kpis(config),
        )
        .where("_timed > 0")
        .drop("_timed")
        .orderBy("test_date")
    )


def yield_summary(staged: DataFrame, config: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Yield KPIs over all labels, untimed ones included: one row."""
    tested, failed, passed = _tallies(config)
    return staged.agg(
        tested.alias("total_wafers"),
        failed.alias("total_fails"),
        passed.alias("total_passes"),
        percentage(failed, tested).alias("overall_fail_rate_pct"),
        percentage(passed, tested).alias("overall_yield_rate_pct"),
        F.min("tested_at").alias("first_test_at"),
        F.max("tested_at").alias("last_test_at"),
    )
