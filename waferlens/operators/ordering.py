"""Running totals over a total order, without one task seeing all rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waferlens.shared import materialise, stage_table

# Up to this many rows one sorted task is cheaper than a range shuffle.
SINGLE_TASK_ROWS = 1_000_000


def running_sum(
    df: DataFrame,
    order: Sequence[Column | str],
    amount: Column | str,
    name: str,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Add ``name``: the sum of ``amount`` over all rows up to and including this one.

    ``order`` must be total. The input is computed once, which fixes both its
    size and any float that a re-run could sum in another order. A small table
    is summed in one window; a larger one is range-partitioned and written
    once, and each file is added up from the total of the files before it.
    """
    amount = F.col(amount) if isinstance(amount, str) else amount
    fixed = materialise(df.withColumn("_amount", amount))
    if fixed.count() <= single_task_rows:
        window = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return fixed.withColumn(name, F.sum("_amount").over(window)).drop("_amount")

    # Sorted once and written out, a file for each range: what comes before a row is then
    # known from totals of files, and no second shuffle is needed.
    ranged = stage_table(
        fixed.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    return _added_up(ranged, df.columns, name)


def _added_up(ranged: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Running totals of ``_amount`` over files in the order of ``_range``, task by task.

    A scan may part a file or read several one after the other. Totals are
    taken for each part, and a task adds up from what comes before its part.
    """
    parted = ranged.withColumn("_part", F.col("_metadata.file_block_start"))
    totals = (
        parted.groupBy("_range", "_part").agg(F.sum("_amount").alias("_total")).collect()
    )
    before, reached = {}, 0
    for row in sorted(totals, key=lambda row: (row["_range"], row["_part"])):
        before[row["_range"], row["_part"]] = reached
        reached += row["_total"] or 0
    kind = T.DoubleType() if isinstance(reached, float) else T.LongType()
    arrow = pa.float64() if isinstance(reached, float) else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, total = None, 0
        for whole in batches:
            ranges, parts = (whole.column(c).to_numpy() for c in ("_range", "_part"))
            moved = (ranges[1:] != ranges[:-1]) | (parts[1:] != parts[:-1])
            cuts = [0, *(np.flatnonzero(moved) + 1).tolist(), whole.num_rows]
            for start, end in zip(cuts, cuts[1:], strict=False):
                if start == end:
                    continue
                batch = whole.slice(start, end - start)
                if (now := (int(ranges[start]), int(parts[start]))) != place:
                    place, total = now, before[now]
                amounts = pc.fill_null(batch.column("_amount").cast(arrow), 0).to_numpy()
                sums = np.cumsum(amounts) + total
                total = sums[-1].item()
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in columns), pa.array(sums, arrow)],
                    names=[*columns, name],
                )

    schema = T.StructType([*(ranged.schema[c] for c in columns), T.StructField(name, kind)])
    return parted.mapInArrow(run, schema)


def global_rank(
    df: DataFrame,
    order: Sequence[Column | str],
    name: str,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Add ``name``: 1..n by ``order`` (which must be total), as a long."""
    return running_sum(df, order, F.lit(1).cast("long"), name, single_task_rows)
