"""Pass/fail logs: one ``<label> "<timestamp>"`` line per wafer."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waferlens.functions.columns import strip_blanks
from waferlens.sources.ordinals import number_rows, read_lines


class ParsedLabels(NamedTuple):
    accepted: DataFrame
    quarantined: DataFrame


def split_label_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Add the label text and the timestamp text of each line.

    A quoted timestamp is everything after the first quote. Without quotes only
    the second word is kept, so a time after a date is lost.
    """
    text = F.col("_text")
    quote = F.instr(text, '"')
    after_quote = F.replace(F.substring(text, quote + 1, F.length(text)), F.lit('"'), F.lit(""))
    words = F.split(text, r"\s+", 3)
    return (
        lines.withColumn("_text", strip_blanks(F.col(line)))
        .withColumns(
            {
                "label_text": F.when(
                    quote > 0, strip_blanks(F.substring_index(text, '"', 1))
                ).otherwise(F.get(words, F.lit(0))),
                "timestamp_str": F.when(quote > 0, strip_blanks(after_quote)).otherwise(
                    F.get(words, F.lit(1))
                ),
            }
        )
        .drop("_text")
    )


def parse_labels(numbered: DataFrame, wafer: str = "wafer_id", line: str = "value") -> DataFrame:
    """Label lines to (wafer, label, timestamp text); a line without an integer label raises."""
    unreadable = F.raise_error(F.concat(F.lit("not an integer label: "), F.col(line)))
    return split_label_lines(numbered, line).select(
        wafer,
        F.coalesce(F.col("label_text").try_cast("int"), unreadable.cast("int")).alias(
            "pass_fail_raw"
        ),
        "timestamp_str",
    )


def parse_labels_quarantined(
    numbered: DataFrame, wafer: str = "wafer_id", line: str = "value"
) -> ParsedLabels:
    """The same, with unreadable lines set aside under the number they have in the file."""
    split = split_label_lines(numbered, line).withColumn(
        "pass_fail_raw", F.col("label_text").try_cast("int")
    )
    readable = F.col("pass_fail_raw").isNotNull()
    return ParsedLabels(
        split.where(readable).select(wafer, "pass_fail_raw", "timestamp_str"),
        split.where(~readable).select(wafer, line),
    )


def read_labels(spark: SparkSession, path: str | list[str], wafer: str = "wafer_id") -> DataFrame:
    return parse_labels(number_rows(read_lines(spark, path), wafer, path), wafer)


def read_labels_quarantined(
    spark: SparkSession, path: str | list[str], wafer: str = "wafer_id"
) -> ParsedLabels:
    return parse_labels_quarantined(number_rows(read_lines(spark, path), wafer, path), wafer)
