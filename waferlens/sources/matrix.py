"""Headerless whitespace-delimited number matrices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waferlens.config import sensor_names
from waferlens.functions.columns import nan_to_null, strip_blanks
from waferlens.sources.ordinals import number_rows, place_blocks, read_lines

# Spellings of a missing number in a text file.
MISSING_TOKENS = [
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def parse_values(line: Column) -> Column:
    """``array<double>`` of a line; missing spellings become NULL, other non-numbers raise.

    Only lines with a word that is no number are looked at word by word.
    """
    words = F.split(strip_blanks(line), r"\s+")
    numbers = words.try_cast("array<double>")

    def checked(word: Column) -> Column:
        unreadable = F.raise_error(F.concat(F.lit("not a number in matrix: "), word))
        number = F.coalesce(word.try_cast("double"), unreadable.cast("double"))
        return F.when(~word.isin(MISSING_TOKENS), nan_to_null(number))

    return F.when(
        F.exists(numbers, lambda number: number.isNull()), F.transform(words, checked)
    ).otherwise(F.transform(numbers, nan_to_null))


def read_matrix(spark: SparkSession, path: str | list[str], wafer: str = "wafer_id") -> DataFrame:
    """(wafer, values): one row per non-blank line, numbered in file order.

    The array layout keeps the schema at two columns however many channels
    there are; ``widen`` projects named columns on demand. The first line says
    how many channels there are: shorter lines are padded with NULL, longer
    ones are an error.
    """
    lines = read_lines(spark, path)
    channels = F.size(F.split(strip_blanks(F.col("value")), r"\s+"))
    placed = place_blocks(
        lines,
        path,
        {
            "_least": F.min(channels),
            "_most": F.max(channels),
            "_width": F.min_by(channels, F.col("place")),
        },
    )
    sizes = placed.agg(
        F.min_by("_width", F.col("_first") + F.col("_shift")).alias("first"),
        F.min("_least").alias("least"),
        F.max("_most").alias("most"),
    ).first()
    width = sizes["first"]
    if sizes["most"] is not None and sizes["most"] > width:
        raise ValueError(f"a matrix line has {sizes['most']} numbers, the first has {width}")
    parsed = lines.withColumn("values", parse_values(F.col("value"))).drop("value")
    numbered = number_rows(parsed, wafer, placed=placed)
    values = F.col("values")
    if sizes["least"] != width:
        padding = F.array_repeat(F.lit(None).cast("double"), F.lit(width) - F.size(values))
        values = F.concat(values, padding).alias("values")
    return numbered.select(wafer, values)


def matrix_width(matrix: DataFrame, values: str = "values") -> int:
    """Channels of a matrix; every row has the same number."""
    row = matrix.select(F.size(values)).first()
    return row[0] if row else 0


def widen(
    matrix: DataFrame, width: int | None = None, wafer: str = "wafer_id", values: str = "values"
) -> DataFrame:
    """Named ``sensor_NNN`` columns."""
    width = matrix_width(matrix, values) if width is None else width
    return matrix.select(
        wafer,
        *[F.get(values, F.lit(i)).alias(name) for i, name in enumerate(sensor_names(width))],
    )
