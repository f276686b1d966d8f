"""Helpers shared by the text operators: words, Arrow columns, bounded joins."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waferlens.shared import stage_table

# A side is broadcast up to this many rows; beyond it the join is salted instead.
BROADCAST_ROWS = 20_000
# So many ways a hot key of a salted join is split.
SALTS = 32
# Rows of an Arrow batch that are worked on together, whose texts are then copied.
ROWS_AT_ONCE = 1024

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


UPPER, LOWER = (bytes(range(a, a + 26)).decode() for a in (0x41, 0x61))


def sql_words(text: str, pattern: str) -> str:
    """DuckDB's SQL for the words of a text; a null text has none."""
    return f"regexp_extract_all(coalesce({text}, ''), '{pattern}')"


def sql_lower(text: str) -> str:
    """DuckDB's SQL for a text with A-Z as a-z and all else as it is."""
    return f"translate({text}, '{UPPER}', '{LOWER}')"


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding them."""
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    return column.cast(pa.large_binary() if large else pa.binary()).to_pylist()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word; the same on every machine."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words, in order; empty if there are fewer words."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = hashes[:count].copy()
    for step in range(1, size):
        total *= MULTIPLIER
        total += hashes[step : step + count]
    return mix(total)


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def fresh_name(taken: Sequence[str], wanted: str) -> str:
    """``wanted``, with underscores in front until no column has that name."""
    lowered = {name.lower() for name in taken}
    while wanted.lower() in lowered:
        wanted = f"_{wanted}"
    return wanted


def append_columns(
    df: DataFrame,
    inputs: Sequence[str],
    fields: Sequence[T.StructField],
    compute: Callable[[list[pa.Array]], list[pa.Array]],
) -> DataFrame:
    """All columns of ``df`` and ``fields``, computed some rows at a time from ``inputs``.

    The rows stay where they are: nothing is shuffled, and other columns pass
    through whatever their types are.
    """
    places = [df.columns.index(name) for name in inputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                added = compute([batch.column(place) for place in places])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *added],
                    names=[*batch.schema.names, *(field.name for field in fields)],
                )

    return df.mapInArrow(run, T.StructType([*df.schema.fields, *fields]))


def join_bounded(
    rows: DataFrame, side: DataFrame, keys: Sequence[str], how: str, most: int = BROADCAST_ROWS
) -> DataFrame:
    """Join ``rows`` with a staged ``side`` that has one row for each key.

    The side is broadcast if it was counted to have at most ``most`` rows.
    Beyond that both are shuffled, with each key dealt over ``SALTS``
    partitions so that a hot one is split.
    """
    if side.count() <= most:
        return rows.join(F.broadcast(side), [*keys], how)
    salt = fresh_name([*rows.columns, *side.columns], "_salt")
    salted = rows.withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    copies = side.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies.withColumn(salt, F.col(salt).cast("long")), [*keys, salt], how).drop(
        salt
    )


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder, so that a lost executor costs no recomputation."""
    return stage_table(df, f"llm-{name}")


def squeezed(docs: DataFrame, once: Sequence[str] = ()) -> DataFrame:
    """The other columns, and ``text`` compressed as ``small``, for the way through a shuffle.

    Rows that are equal in the columns ``once`` go once from a task, or a few times.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        gone: set[tuple] = set()
        for batch in batches:
            if once:
                first = []
                for key in zip(*(batch.column(name).to_pylist() for name in once), strict=True):
                    first.append(key not in gone)
                    gone.add(key)
                batch = batch.filter(pa.array(first, pa.bool_()))
                if len(gone) > 200_000:
                    gone.clear()
            small = [pack(text or b"") for text in text_bytes(batch.column(0))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(small, pa.binary())],
                names=[*batch.schema.names[1:], "small"],
            )

    others = [name for name in docs.columns if name != "text"]
    chosen = docs.select("text", *others)
    schema = T.StructType([*chosen.schema.fields[1:], T.StructField("small", T.BinaryType())])
    return chosen.mapInArrow(run, schema)


@lru_cache(maxsize=1)
def unsqueezer() -> Callable[[bytes], bytes]:
    import zstandard

    return zstandard.ZstdDecompressor().decompress
