"""Product codes of vectors, their codebooks fitted by ball k-means in whole numbers.

A vector is cut into parts; each part position has a codebook, and the code of a
vector names the nearest entry for each part. An entry and the parts that it
holds form a ball. From one round to the next a part compares first with the
entry it has:

* the ball's radius and how far its entry has moved bound every distance to the
  entry, so entries more than twice that away are no neighbours of the ball;
* a part nearer to its entry than half the way to the nearest neighbour is in
  the stable core and is compared with nothing else;
* others lie in rings, by half the ways to the neighbours in order, and are
  compared with the neighbours up to their ring only.

All distances are squared sums of integers, so no entry is left out that could
be nearer or equally near with a lower index: the result is that of a full search.

The vectors are written once as integers and once a round with the entries they
have; what a round reads is removed when the next is written. Sums, counts and
radii are added up in the tasks, one row for each entry and place, and those
rows, whose number depends on the codebooks alone, go to the driver.

Defined results: rows whose vector is null, or holds null or non-finite
components, are dropped; the rest must have one length, which the parts divide,
and components under 8192 in size, else a ValueError says so. The first entries
come from the smallest ids, null ids last, equal ids by vector; with fewer
vectors than entries there are fewer entries. Repeated rows count as often as
they occur. Null labels are one label. An empty table gives no rows. Other
columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waferlens.llm.common import fresh_name, join_bounded, staged
from waferlens.shared import remove_path, scratch_path

PARTS, ENTRIES, ROUNDS = 8, 16, 6
SCALE = 4096
# Components stay under this, so that squared distances of 2,000 of them fit 64 bits.
MOST = 1 << 25
STATE = "vec_id long, label int, numbers array<int>, codes binary"
CODED = "vec_id long, label int, codes binary, error long"
TOTALS = "part int, entry int, place int, amount long, members long, radius long"


@dataclass(frozen=True)
class Codebook:
    """Entries of one part position, and which of them are neighbours of each ball.

    ``near[i]`` lists the entries that a member of ball ``i`` may have to be
    compared with, nearest first, and ``ways[i]`` their squared distances.
    """

    entries: np.ndarray  # entries x components
    near: list[np.ndarray]
    ways: list[np.ndarray]

    @staticmethod
    def of(entries: np.ndarray, reach: list[int | None]) -> Codebook:
        """``reach`` bounds the distance of a ball's members to its entry; None if unknown."""
        apart = ((entries[:, None] - entries[None]) ** 2).sum(axis=2)
        near, ways = [], []
        for i, most in enumerate(reach):
            order = np.argsort(apart[i], kind="stable")
            order = order[order != i]
            if most is not None:
                order = order[apart[i][order] <= 4 * most * most]
            near.append(order)
            ways.append(apart[i][order])
        return Codebook(entries, near, ways)

    def assign(self, parts: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each part and its squared distance, from the entries ``held``."""
        best = held.copy()
        least = ((parts - self.entries[held]) ** 2).sum(axis=1)
        for i in np.unique(held):
            ball = np.flatnonzero(held == i)
            # The ring of a part: how many neighbours are no more than twice its distance away.
            ring = np.searchsorted(self.ways[i], 4 * least[ball], side="right")
            outside = ring > 0
            ball, ring = ball[outside], ring[outside]
            order = np.argsort(-ring, kind="stable")
            ball, ring = ball[order], ring[order]
            reached = np.searchsorted(-ring, -np.arange(1, len(self.near[i]) + 1), side="right")
            for entry, count in zip(self.near[i].tolist(), reached.tolist(), strict=True):
                if not count:
                    break
                some = ball[:count]
                way = ((parts[some] - self.entries[entry]) ** 2).sum(axis=1)
                now = least[some]
                closer = (way < now) | ((way == now) & (entry < best[some]))
                best[some[closer]] = entry
                least[some[closer]] = way[closer]
        return best, least


def whole_numbers(
    table: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """The rows with a usable vector, its components scaled and rounded down."""
    x = F.col(vector)
    usable = x.isNotNull() & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    )
    number = F.transform(x, lambda v: F.floor(v.cast("double") * SCALE))
    fits = F.forall(number, lambda v: F.abs(v) < MOST)
    refused = F.raise_error(F.lit("a component is not under 8192 in size")).cast("array<int>")
    return table.where(usable).select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(label).cast("int").alias("label"),
        F.when(fits, number.cast("array<int>")).otherwise(refused).alias("numbers"),
    )


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The vectors of a batch, one a row."""
    lists = batch.column(2)
    if len(lists) and set(lists.value_lengths().unique().to_pylist()) != {width}:
        raise ValueError(f"vectors of other lengths than {width}")
    return lists.flatten().to_numpy().astype(np.int64).reshape(len(lists), width)


def _held(batch: pa.RecordBatch, parts: int) -> np.ndarray:
    """The entries that the parts of a batch have, one vector a row."""
    joined = b"".join(batch.column(3).to_pylist())
    return np.frombuffer(joined, np.uint8).reshape(batch.num_rows, parts).astype(np.int64)


def _assigned(batch: pa.RecordBatch, books: list[Codebook], width: int):
    """Entries and squared distances of all parts of a batch, one vector a row each."""
    size = width // len(books)
    numbers, held = _matrix(batch, width), _held(batch, len(books))
    found = [
        book.assign(numbers[:, p * size : (p + 1) * size], held[:, p]) for p, book in enumerate(books)
    ]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _packed(codes: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in codes.astype(np.uint8)], pa.binary())


def assign(state: DataFrame, books: list[Codebook], width: int) -> DataFrame:
    """``state`` with the nearest entry of each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, _ = _assigned(batch, books, width)
            columns = [*batch.columns[:3], _packed(codes)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return state.mapInArrow(run, STATE)


def coded(state: DataFrame, books: list[Codebook], width: int) -> DataFrame:
    """The last assignment: codes and the squared distance of each vector to its entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, ways = _assigned(batch, books, width)
            error = pa.array(ways.sum(axis=1), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], _packed(codes), error],
                names=["vec_id", "label", "codes", "error"],
            )

    return state.mapInArrow(run, CODED)


def totals(state: DataFrame, books: list[Codebook], width: int) -> DataFrame:
    """For each entry and place the sum of its members, their number and the squared radius."""
    size, entries = width // len(books), len(books[0].entries)
    shape = (len(books), entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        amount = np.zeros((*shape, size), np.int64)
        members, radius = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
        for batch in batches:
            numbers, held = _matrix(batch, width), _held(batch, len(books))
            for p, book in enumerate(books):
                parts, own = numbers[:, p * size : (p + 1) * size], held[:, p]
                way = ((parts - book.entries[own]) ** 2).sum(axis=1)
                np.add.at(amount[p], own, parts)
                np.maximum.at(radius[p], own, way)
                members[p] += np.bincount(own, minlength=entries)
        # A row even where vectors have no components at all.
        grid = np.indices((*shape, max(size, 1))).reshape(3, -1)
        part, entry, place = grid
        sums = amount.reshape(-1) if size else np.zeros(len(part), np.int64)
        columns = [sums, members[part, entry], radius[part, entry]]
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int32()) for c in grid), *(pa.array(c, pa.int64()) for c in columns)],
            names=["part", "entry", "place", "amount", "members", "radius"],
        )

    return (
        state.mapInArrow(run, TOTALS)
        .groupBy("part", "entry", "place")
        .agg(
            F.sum(F.col("amount").cast("decimal(38,0)")).alias("amount"),
            F.sum("members").alias("members"),
            F.max("radius").alias("radius"),
        )
    )


def moved(books: list[Codebook], rows: list) -> tuple[list[Codebook], bool]:
    """The codebooks after a round, and whether any entry moved."""
    fresh = [book.entries.copy() for book in books]
    radius: dict[tuple[int, int], int] = {}
    for row in rows:
        part, entry, place, members = row["part"], row["entry"], row["place"], row["members"]
        radius[part, entry] = row["radius"]
        if members and place < fresh[part].shape[1]:
            fresh[part][entry, place] = int(row["amount"]) // members
    out, any_moved = [], False
    for p, (book, entries) in enumerate(zip(books, fresh, strict=True)):
        step = ((entries - book.entries) ** 2).sum(axis=1).tolist()
        any_moved |= any(step)
        # Square roots are rounded up, so that the bound holds.
        reach = [isqrt(radius.get((p, e), 0)) + 1 + (isqrt(s) + 1 if s else 0) for e, s in enumerate(step)]
        out.append(Codebook.of(entries, reach))
    return out, any_moved


def first_books(state: DataFrame, parts: int, entries: int) -> tuple[list[Codebook], int]:
    """Codebooks of the vectors with the smallest ids, and the length of vectors."""
    first = state.orderBy(F.col("vec_id").asc_nulls_last(), "numbers").limit(entries).collect()
    if not first:
        return [], 0
    width = len(first[0]["numbers"])
    if width % parts or any(len(row["numbers"]) != width for row in first):
        raise ValueError(f"vectors need one length that {parts} parts divide")
    vectors = np.array([row["numbers"] for row in first], np.int64).reshape(len(first), parts, -1)
    return [Codebook.of(vectors[:, p], [None] * len(first)) for p in range(parts)], width


def fit(
    numbers: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[list[Codebook], DataFrame]:
    """Codebooks after ``rounds`` rounds, and the staged result of ``coded``.

    ``numbers`` are the rows of ``whole_numbers``. Rounds after which no entry
    moved are not repeated: the next would change nothing.
    """
    if not 0 < entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    spark = numbers.sparkSession
    paths: list[str] = []

    def written(state: DataFrame) -> DataFrame:
        paths.append(scratch_path(spark, "llm-codes"))
        state.write.option("compression", "zstd").parquet(paths[-1])
        if len(paths) > 1:
            remove_path(spark, paths[-2])
        return spark.read.schema(STATE).parquet(paths[-1])

    # All parts begin in the first entry's ball.
    state = written(numbers.withColumn("codes", F.lit(bytes(parts))))
    books, width = first_books(state, parts, entries)
    if not books:
        return [], staged(spark.createDataFrame([], CODED), "coded")
    for _ in range(rounds):
        state = written(assign(state, books, width))
        books, any_moved = moved(books, totals(state, books, width).collect())
        if not any_moved:
            break
    done = staged(coded(state, books, width), "coded")
    remove_path(spark, paths[-1])
    return books, done


def digest(books: list[Codebook]) -> str:
    """SHA-256 of all components as decimals, by part, entry and place, with commas."""
    numbers = (n for book in books for n in book.entries.ravel().tolist())
    return hashlib.sha256(",".join(map(str, numbers)).encode()).hexdigest()


def compress(
    table: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Code and error of each kept vector, the error of its label, the codebooks' digest."""
    books, done = fit(whole_numbers(table, id_column, vector, label), parts, entries, rounds)
    # Null labels join as a value of their own.
    key, none = (fresh_name(done.columns, n) for n in ("_label", "_none"))
    keyed = done.withColumns({key: F.coalesce("label", F.lit(0)), none: F.col("label").isNull()})
    by_label = staged(
        keyed.groupBy(key, none).agg(F.sum("error").alias("label_error")), "label-errors"
    )
    return join_bounded(keyed, by_label, [key, none], "inner").select(
        "vec_id",
        F.lower(F.hex("codes")).alias("code"),
        "error",
        "label_error",
        F.lit(digest(books)).alias("codebooks_sha256"),
    )


def brute_force(rows: list, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list:
    """The same by plain search, for tests: rows of (id, vector, label)."""
    kept = []
    for key, vector, label in rows:
        if vector is not None and all(v is not None and np.isfinite(v) for v in vector):
            kept.append((key, [int(np.floor(float(v) * SCALE)) for v in vector], label))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    size = len(kept[0][1]) // parts
    cut = [[v[p * size : (p + 1) * size] for _, v, _ in kept] for p in range(parts)]
    books = [[list(x) for x in column[:entries]] for column in cut]

    def nearest(book: list, x: list) -> tuple[int, int]:
        return min((sum((a - b) ** 2 for a, b in zip(x, y, strict=True)), e) for e, y in enumerate(book))

    for _ in range(rounds):
        for book, column in zip(books, cut, strict=True):
            held = [nearest(book, x)[1] for x in column]
            for e in range(len(book)):
                members = [x for x, h in zip(column, held, strict=True) if h == e]
                if members:
                    book[e] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    found = [[nearest(book, column[i]) for book, column in zip(books, cut, strict=True)] for i in range(len(kept))]
    by_label: dict = {}
    for (_, _, label), one in zip(kept, found, strict=True):
        by_label[label] = by_label.get(label, 0) + sum(d for d, _ in one)
    text = ",".join(str(n) for book in books for entry in book for n in entry)
    sha = hashlib.sha256(text.encode()).hexdigest()
    return [
        (key, "".join(f"{e:02x}" for _, e in one), sum(d for d, _ in one), by_label[label], sha)
        for (key, _, label), one in zip(kept, found, strict=True)
    ]


def sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same in DuckDB's SQL, by full search, the rounds written out."""
    way = "list_sum(list_transform(list_zip(x, y), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""held{r} AS MATERIALIZED (
    SELECT row, part, min({{'way': CAST({way} AS HUGEINT), 'entry': entry}}) AS best
    FROM cut JOIN book{r} USING (part) GROUP BY row, part)""")
        if r == rounds:
            break
        steps.append(f"""sums{r} AS (
    SELECT part, best.entry AS entry, place, sum(x[place]) AS s, count(*) AS n
    FROM cut JOIN held{r} USING (row, part), unnest(range(1, len(x) + 1)) AS u(place)
    GROUP BY part, best.entry, place),
means{r} AS (
    SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY place) AS y
    FROM sums{r} GROUP BY part, entry),
book{r + 1} AS MATERIALIZED (
    SELECT part, entry, coalesce(m.y, b.y) AS y
    FROM book{r} b LEFT JOIN means{r} m USING (part, entry))""")
    between = ",\n".join(steps)
    return f"""WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, numbers) AS row, vec_id, label, numbers
    FROM (SELECT vec_id, label, list_transform(embedding,
            lambda v: CAST(floor({SCALE} * CAST(v AS DOUBLE)) AS BIGINT)) AS numbers
        FROM embeddings
        WHERE embedding IS NOT NULL
          AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0)),
cut AS MATERIALIZED (
    SELECT row, part, numbers[part * (len(numbers) // {parts}) + 1 : (part + 1) * (len(numbers) // {parts})] AS x
    FROM kept, unnest(range({parts})) AS u(part)),
book0 AS MATERIALIZED (SELECT part, row - 1 AS entry, x AS y FROM cut WHERE row <= {entries}),
{between},
codes AS (
    SELECT row, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code,
        CAST(sum(best.way) AS BIGINT) AS error
    FROM held{rounds} GROUP BY row),
books AS (
    SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY part, entry)) AS codebooks_sha256
    FROM book{rounds})
SELECT vec_id, code, error,
    CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN codes USING (row) CROSS JOIN books"""
