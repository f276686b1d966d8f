"""Distinct counts from sketches that are stored once and merged, never reread.

The opt-in next to exact distinct counts. A HyperLogLog sketch of 2**12
registers takes a few kilobytes, whatever it has seen. One is stored for each
day; any span of days is counted by merging theirs, and a day that comes again
replaces its own. Parts merge to the very registers that one pass over all rows
gives, in any order, so the estimate does not depend on how rows came in.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Logarithm of the number of registers.
REGISTERS_LOG = 12
SKETCH = "sketch"


def error_bound(registers_log: int = REGISTERS_LOG) -> float:
    """Three standard errors: the relative error that an estimate stays under."""
    return 3 * 1.04 / math.sqrt(2**registers_log)


def distinct_sketches(
    df: DataFrame, column: str, by: Sequence[str] = (), registers_log: int = REGISTERS_LOG
) -> DataFrame:
    """(by, sketch) of the values of ``column``; NULL is no value. Sketches combine map-side."""
    value = F.col(column)
    if df.schema[column].dataType.typeName() not in ("integer", "long", "string", "binary"):
        value = value.cast("string")
    return df.groupBy(*by).agg(F.hll_sketch_agg(value, F.lit(registers_log)).alias(SKETCH))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of coarser groups, from one row for each finer one."""
    return sketches.groupBy(*by).agg(F.hll_union_agg(SKETCH).alias(SKETCH))


def distinct_estimate(sketch: Column | str = SKETCH) -> Column:
    """The number of distinct values, by the registers alone.

    A sketch that was never merged remembers the order its values came in; the
    union with itself forgets it, so merged or not the estimate is the same.
    """
    return F.hll_sketch_estimate(F.hll_union(sketch, sketch))


def store_sketches(sketches: DataFrame, path: str, day: str) -> None:
    """Put each day's sketch in place of an earlier one; other days stay as they are."""
    writer = sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(day).parquet(path)
