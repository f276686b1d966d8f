"""Joins with a side that is usually small: its size is counted, and there is a way beyond."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# So many ways a hot key of a salted join is split.
SALTS = 32


def bounded_join(
    rows: DataFrame,
    side: DataFrame,
    keys: str | Sequence[str],
    how: str = "inner",
    most: int = 100_000,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``rows`` (inner, left or left_semi) with a fixed ``side`` of one row for each key.

    The side is counted here, so it should be a checkpoint or a stored table. Up
    to ``most`` rows it is broadcast. Beyond that both are shuffled, each key
    dealt over ``salts`` partitions, so that a hot one is no single task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if side.count() <= most:
        return rows.join(F.broadcast(side), keys, how)
    salt = "_salt"
    while salt in rows.columns or salt in side.columns:
        salt = f"_{salt}"
    dealt = rows.withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(salts)))
    copies = side.withColumn(
        salt, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))
    )
    return dealt.join(copies, [*keys, salt], how).drop(salt)
