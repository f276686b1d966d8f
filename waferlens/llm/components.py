"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waferlens.llm.common import staged

MOST_ROUNDS = 60


class Forest:
    """Union-find over whole numbers, where the smallest of a set is its root."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, node: int) -> int:
        parent = self.parent
        top = node
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(node, node)) != top:
            parent[node] = top
            node = up
        return top

    def join(self, left: int, right: int) -> bool:
        left, right = self.root(left), self.root(right)
        if left == right:
            return False
        low, high = min(left, right), max(left, right)
        self.parent[high] = self.parent[low] = low
        return True


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest = Forest()
    for batch in batches:
        for left, right in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            forest.join(left, right)
    nodes = np.fromiter(forest.parent, np.int64, len(forest.parent))
    roots = np.fromiter(map(forest.root, forest.parent), np.int64, len(nodes))
    moved = nodes != roots
    yield pa.RecordBatch.from_arrays(
        [pa.array(nodes[moved]), pa.array(roots[moved])], names=["high", "low"]
    )


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One step: every node points its neighbours (the larger, or the smaller) at the least."""
    if small:
        sides = edges
    else:
        sides = edges.union(edges.select(F.col("low"), F.col("high"))).toDF("high", "low")
    least = sides.groupBy("high").agg(F.min("low").alias("_least"))
    least = least.withColumn("_least", F.least("_least", "high"))
    near = sides if small else sides.where(F.col("low") > F.col("high"))
    moved = near.join(least, "high").select(F.col("low").alias("high"), F.col("_least").alias("low"))
    if small:
        moved = moved.union(least)
    return moved.where(F.col("high") > F.col("low")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of an edge, by its smallest node.

    Each partition first replaces its edges by stars, which needs memory for
    its own nodes only. Then large and small stars alternate over the whole
    table until nothing moves; every round is written to the shared folder.
    """
    left, right = edges.columns
    pairs = edges.select(
        F.greatest(left, right).alias("high"), F.least(left, right).alias("low")
    ).where(F.col("high") > F.col("low"))
    now = staged(pairs.mapInArrow(_local_stars, "high long, low long").distinct(), "stars")
    seen = None
    for _ in range(MOST_ROUNDS):
        state = now.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("high", "low")), F.sum(F.col("low") % 1_000_003)
        ).first()
        if tuple(state) == seen or not state[0]:
            return now.select(F.col("high").alias("node"), F.col("low").alias("component")).union(
                now.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
            )
        seen = tuple(state)
        now = staged(_star(_star(now, small=False), small=True), "stars")
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
