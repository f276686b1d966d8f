"""Row numbers in file order, for files whose row order is the key."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waferlens.functions.columns import strip_blanks
from waferlens.operators.ordering import SINGLE_TASK_ROWS, running_sum
from waferlens.shared import materialise

# A block list longer than this (about 128 TB of text) is joined by shuffle.
BROADCAST_BLOCKS = 1_000_000
BLOCK = ["file_path", "block_start"]


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Non-blank lines with the file block each came from and their place in it."""
    return (
        spark.read.text(path if isinstance(path, str) else list(path))
        .select(
            "value",
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("block_start"),
        )
        .where(strip_blanks(F.col("value")) != "")
        .withColumn("place", F.monotonically_increasing_id())
    )


def _location(spark: SparkSession, path: str) -> str:
    """A path as file metadata spell it."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return re.sub(r"^file:/+", "file:/", files.makeQualified(place).toUri().toString())


def natural_order(text: Column) -> Column:
    """A text whose numbers sort as numbers: 2 before 10, part 99999 before part 100000."""
    padded = F.regexp_replace(text, r"(\d+)", "0" * 20 + "$1")
    return F.regexp_replace(padded, r"\d*(\d{20})(?!\d)", "$1")


def _ordered_files(blocks: DataFrame, paths: str | Sequence[str] | None) -> DataFrame:
    """Add ``_given`` and ``_natural``: the order of files, checked to be one.

    Files come in the order of the given list; those of a folder by name, with
    numbers as numbers. A list entry may be a file or a folder, no pattern.
    """
    ordered = blocks.withColumn("_natural", natural_order(F.col("file_path")))
    if paths is None or isinstance(paths, str):
        placed = ordered.withColumn("_given", F.lit(0).cast("long"))
    else:
        spark = blocks.sparkSession
        given = [(_location(spark, path), number) for number, path in enumerate(paths)]
        listed = spark.createDataFrame(given, "_entry string, _given long")
        listed = listed.groupBy("_entry").agg(F.min("_given").alias("_given"))
        parts = F.split(F.regexp_replace("file_path", "^file:/+", "file:/"), "/")
        entries = F.transform(
            F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/")
        )
        files = blocks.select("file_path").distinct().select("file_path", F.explode(entries).alias("_entry"))
        order = files.join(listed, "_entry").groupBy("file_path").agg(F.min("_given").alias("_given"))
        placed = ordered.join(order, "file_path", "left")
    placed = materialise(placed)
    names = placed.select("_given", "_natural", "file_path").distinct()
    if not placed.where(F.col("_given").isNull()).isEmpty():
        raise ValueError("a file belongs to no entry of the list; name files or folders")
    twins = names.groupBy("_given", "_natural").count().where(F.col("count") > 1)
    if not twins.isEmpty():
        raise ValueError(f"file names give no order: {twins.first()['_natural']}")
    return placed


def place_blocks(
    lines: DataFrame,
    paths: str | Sequence[str] | None = None,
    measures: Mapping[str, Column] | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """For each file block its rows, its first place, and what to add to get row numbers.

    One scan of the text; ``measures`` are more aggregates over a block's lines.
    """
    blocks = lines.groupBy(*BLOCK).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.min("place").alias("_first"),
        *(measure.alias(name) for name, measure in (measures or {}).items()),
    )
    ordered = _ordered_files(materialise(blocks), paths)
    order = ["_given", "_natural", "block_start"]
    counted = running_sum(ordered, order, "_rows", "_upto", single_task_rows)
    shift = F.col("_upto") - F.col("_rows") - F.col("_first") + 1
    return materialise(counted.withColumn("_shift", shift))


def number_rows(
    lines: DataFrame,
    name: str = "wafer_id",
    paths: str | Sequence[str] | None = None,
    placed: DataFrame | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
    broadcast_blocks: int = BROADCAST_BLOCKS,
) -> DataFrame:
    """Replace the file position of ``read_lines`` rows by 1..n in file order.

    The text is scanned twice, to count and to number, and nothing is written.
    Only one row per file block is ever sorted; the rows themselves are
    numbered by adding the count of all earlier blocks, without a shuffle
    while the block list is small enough to broadcast. A row outside its
    counted block means that the second scan parted the files in another way,
    which is an error.
    """
    if placed is None:
        placed = place_blocks(lines, paths, None, single_task_rows)
    offsets = placed.select(*BLOCK, "_first", "_rows", "_shift")
    if placed.count() <= broadcast_blocks:
        offsets = F.broadcast(offsets)
    kept = [c for c in lines.columns if c not in (*BLOCK, "place")]
    inside = F.col("place").between(F.col("_first"), F.col("_first") + F.col("_rows") - 1)
    moved = F.raise_error(F.lit("the files changed while their rows were numbered")).cast("long")
    number = F.when(inside, F.col("place") + F.col("_shift")).otherwise(moved)
    return lines.join(offsets, BLOCK, "left").select(number.alias(name), *kept)
