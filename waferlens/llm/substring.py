"""Removal of repeated passages by super-k-mer partitioning.

A window is a run of ``window`` words. Its minimiser is the smallest hash of the
runs of ``mer`` words in it; consecutive windows of a text with one minimiser
form a super-k-mer, and equal windows have equal minimisers. So the windows of a
super-k-mer travel as one packed string to the bucket of their minimiser, where
the windows are sorted and counted exactly, as text.

Only super-k-mers whose minimiser was seen twice travel at all: minimisers are
counted first, as plain numbers. Before the shuffle, equal strings of a batch
are sent once, and those that came twice are known to repeat, so a group of
copies costs a bucket one string for each batch. A minimiser with too many
different strings is split further: its windows travel one by one, to
buckets by their own hash.

Defined results: a null text has no words; fewer words than a window stay;
repeated rows are copies of one another, so all their windows go; overlapping
windows of one text (as in a word said over and over) repeat as well. Texts of any
length are read whole, a long super-k-mer in pieces; only id and text are read,
whatever other columns there are. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waferlens.llm.common import (
    join_bounded,
    shingle_hashes,
    signed,
    sql_words,
    squeezed,
    staged,
    text_bytes,
    unsqueezer,
    word_hashes,
)


@dataclass(frozen=True)
class RepeatSettings:
    window: int = 35
    mer: int = 8
    # Longer super-k-mers are cut, so that no string is long.
    most_windows: int = 256
    # A minimiser with more strings than that is split by window. So many strings
    # have about 150,000 windows, which a task sorts in some 50 MB.
    bucket_rows: int = 10_000


PACKED = (
    "mini long, sub long, packed binary, times int, key long, text_key long, start int, windows int"
)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").split()


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def super_kmers(words: list[bytes], s: RepeatSettings) -> tuple[np.ndarray, ...]:
    """(minimiser, first window, windows, weight) of each super-k-mer of a text.

    The weight is 2 if the minimiser comes several times in the text, so that
    windows within one super-k-mer could be equal.
    """
    if len(words) < s.window:
        return (np.empty(0, np.uint64), *(np.empty(0, np.int32),) * 3)
    mers = shingle_hashes(word_hashes(words), s.mer)
    least = sliding_least(mers, s.window - s.mer + 1)
    cuts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    ends = np.append(cuts[1:], len(least))
    if (ends - cuts).max() > s.most_windows:
        pieces = [np.arange(a, b, s.most_windows) for a, b in zip(cuts, ends, strict=True)]
        cuts = np.concatenate(pieces)
        ends = np.append(cuts[1:], len(least))
    minimisers = least[cuts]
    ordered = np.sort(mers)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    weight = np.ones(len(cuts), np.int32)
    if len(twice):
        weight += np.isin(minimisers, twice)
    return minimisers, cuts.astype(np.int32), (ends - cuts).astype(np.int32), weight


def _keyed(docs: DataFrame, *columns: str) -> DataFrame:
    return docs.select("text", *columns, *_keys(docs))


def _keys(docs: DataFrame) -> tuple[Column, Column]:
    """Two numbers that tell apart rows with other ids or texts; nulls have values too."""
    return (
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("key"),
        F.xxhash64(F.col("doc_id").isNull(), F.col("text")).alias("text_key"),
    )


def find_super_kmers(docs: DataFrame, s: RepeatSettings) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                found = [super_kmers(words_of(t), s) for t in text_bytes(batch.column(2))]
                counts = [len(f[0]) for f in found]
                columns = [np.concatenate([f[i] for f in found]) for i in range(4)]
                keys = [np.repeat(batch.column(i).to_numpy(), counts) for i in range(2)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (signed(columns[0]), *keys, *columns[1:])],
                    names=["mini", "key", "text_key", "start", "windows", "weight"],
                )

    return docs.select(*_keys(docs), "text").mapInArrow(
        run, "mini long, key long, text_key long, start int, windows int, weight int"
    )


def _packed_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 8
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
    names = [part.split()[0] for part in PACKED.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)], names=names
    )


def once_each(rows: Iterator[tuple]) -> list[tuple]:
    """Rows as in ``PACKED``, where equal strings are sent once.

    Strings that come several times repeat: their places are given back at once,
    in rows without a string, and the string goes on without a place.
    """
    met: dict[tuple, list[tuple]] = {}
    for row in rows:
        met.setdefault(row[:3], []).append(row)
    out = []
    for (mini, sub, packed), same in met.items():
        if len(same) == 1 and same[0][3] == 1:
            out += same
        else:
            out.append((mini, sub, packed, 2, None, None, None, same[0][7]))
            out += ((mini, sub, None, 2, *row[4:]) for row in same if row[6] is not None)
    return out


def pack_candidates(small: DataFrame, hits: DataFrame, s: RepeatSettings) -> DataFrame:
    """The packed strings of the super-k-mers that may hold a repeated window."""

    def strings(batch: pa.RecordBatch) -> Iterator[tuple]:
        keys = (batch.column(i).to_pylist() for i in range(2))
        for key, text_key, blob, found in zip(
            *keys, batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True
        ):
            words = words_of(unsqueezer()(blob))
            for h in found:
                packed = b" ".join(words[h["start"] : h["start"] + h["windows"] + s.window - 1])
                yield h["mini"], 0, packed, 1, key, text_key, h["start"], h["windows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                yield _packed_batch(once_each(strings(whole.slice(at, 4096))))

    joined = small.join(hits, ["key", "text_key"]).select("key", "text_key", "small", "found")
    return joined.mapInArrow(run, PACKED)


def _windows(packed: bytes, count: int, s: RepeatSettings) -> list[bytes]:
    """The windows of a packed string, cut out between its blanks."""
    places = np.flatnonzero(np.frombuffer(packed, np.uint8) == 0x20)
    starts = [0, *(places + 1).tolist()]
    ends = [*places.tolist(), len(packed)]
    return [packed[starts[i] : ends[i + s.window - 1]] for i in range(count)]


def split_windows(rows: DataFrame, s: RepeatSettings) -> DataFrame:
    """Each window of the given strings as a string of its own, with a bucket of its own."""

    def windows(batch: pa.RecordBatch) -> Iterator[tuple]:
        for mini, _, packed, times, key, text_key, start, count in zip(
            *(column.to_pylist() for column in batch.columns), strict=True
        ):
            for i, window in enumerate(_windows(packed, count, s)):
                sub = xxhash.xxh3_64_intdigest(window) >> 1
                yield mini, sub, window, times, key, text_key, None if start is None else start + i, 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                yield _packed_batch(once_each(windows(whole.slice(at, 2048))))

    return rows.mapInArrow(run, PACKED)


def count_bucket(rows: list[tuple], s: RepeatSettings) -> Iterator[tuple[int, int, int, int]]:
    """(key, text key, start, windows) of runs of repeated windows in a bucket's rows.

    A row is (packed, times, key, text key, start, windows).
    """
    texts, places = [], []
    for number, row in enumerate(rows):
        found = _windows(row[0], row[5], s)
        texts += found
        places += ((number, i) for i in range(len(found)))
    order = sorted(range(len(texts)), key=texts.__getitem__)
    repeated = [bytearray(row[5]) for row in rows]
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and texts[order[end]] == texts[order[at]]:
            end += 1
        same = [places[i] for i in order[at:end]]
        if end - at > 1 or rows[same[0][0]][1] > 1:
            for number, i in same:
                repeated[number][i] = 1
        at = end
    for row, flags in zip(rows, repeated, strict=True):
        if row[4] is None or not any(flags):
            continue
        edges = np.flatnonzero(np.diff(np.frombuffer(bytes([0]) + bytes(flags) + bytes([0]), np.int8)))
        for first, after in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            yield row[2], row[3], row[4] + first, after - first


def count_windows(packed: DataFrame, s: RepeatSettings) -> DataFrame:
    """Runs of repeated windows, found in each bucket by sorting its windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def ready() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["key", "text_key", "start", "windows"],
            )

        bucket, rows = None, []
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if row[:2] != bucket:
                    out.extend(count_bucket(rows, s))
                    bucket, rows = row[:2], []
                rows.append(row[2:])
            yield ready()
        out.extend(count_bucket(rows, s))
        yield ready()

    dealt = packed.repartition("mini", "sub").sortWithinPartitions("mini", "sub")
    return dealt.mapInArrow(run, "key long, text_key long, start int, windows int")


def places_of(kmers: DataFrame, twice: DataFrame) -> DataFrame:
    """(key, text key, found): the super-k-mers of each text whose minimiser came twice.

    A set, so that a row that is there a thousand times lists its places once:
    no list is longer than one text.
    """
    return (
        kmers.join(twice, "mini", "left_semi")
        .groupBy("key", "text_key")
        .agg(F.collect_set(F.struct("start", "windows", "mini")).alias("found"))
    )


def runs_of(found: DataFrame) -> DataFrame:
    """(key, text key, runs): the repeated windows of each text, in a set as well."""
    return found.groupBy("key", "text_key").agg(
        F.collect_set(F.struct("start", "windows")).alias("runs")
    )


def repeated_windows(docs: DataFrame, small: DataFrame, s: RepeatSettings) -> DataFrame:
    """(key, text key, start, windows) of all runs of windows that start elsewhere too."""
    kmers = staged(find_super_kmers(docs, s), "super-kmers")
    twice = staged(
        kmers.groupBy("mini").agg(F.sum("weight").alias("times")).where(F.col("times") > 1).select("mini"),
        "minimisers",
    )
    packed = staged(pack_candidates(small, places_of(kmers, twice), s), "packed")
    strings = packed.where(F.col("packed").isNotNull())
    crowded = strings.groupBy("mini").count().where(F.col("count") > s.bucket_rows)
    crowded = staged(crowded.select("mini", F.lit(True).alias("crowded")), "crowded")
    known = packed.where(F.col("packed").isNull()).select("key", "text_key", "start", "windows")
    if not crowded.isEmpty():
        marked = join_bounded(strings, crowded, ["mini"], "left")
        columns = packed.columns
        apart = staged(split_windows(marked.where("crowded").select(columns), s), "windows")
        strings = marked.where(F.col("crowded").isNull()).select(columns).union(
            apart.where(F.col("packed").isNotNull())
        )
        known = known.union(
            apart.where(F.col("packed").isNull()).select("key", "text_key", "start", "windows")
        )
    strings = strings.select("mini", "sub", "packed", "times", "key", "text_key", "start", "windows")
    return count_windows(strings, s).union(known)


def kept_words(words: list[bytes], runs: list[tuple[int, int]], window: int) -> list[bytes]:
    """``words`` without those that a window of any run (start, windows) covers."""
    gone = np.zeros(len(words) + 1, np.int64)
    for start, windows in runs:
        gone[start] += 1
        gone[start + windows + window - 1] -= 1
    stays = np.cumsum(gone[:-1]) == 0
    return [word for word, stay in zip(words, stays.tolist(), strict=True) if stay]


def remove_repeats(docs: DataFrame, settings: RepeatSettings | None = None) -> DataFrame:
    """One row for each row of ``docs`` (``doc_id``, ``text``) with its ``kept`` words.

    Columns: doc_id, n_words, n_removed, kept (the words left, joined by one blank).
    """
    s = settings or RepeatSettings()
    plain = docs.select("doc_id", "text")
    runs = runs_of(repeated_windows(plain, squeezed(_keyed(plain)), s))
    kind = plain.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, texts = [], [], []
            for blob, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = words_of(unsqueezer()(blob))
                kept = words
                if found:
                    kept = kept_words(words, [(f["start"], f["windows"]) for f in found], s.window)
                total.append(len(words))
                removed.append(len(words) - len(kept))
                texts.append(b" ".join(kept))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(total, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )

    joined = squeezed(_keyed(plain, "doc_id")).join(staged(runs, "runs"), ["key", "text_key"], "left")
    return joined.select("doc_id", "small", "runs").mapInArrow(
        run, f"doc_id {kind}, n_words long, n_removed long, kept string"
    )


def digest(kept: DataFrame) -> DataFrame:
    return kept.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


def sql(window: int = 35) -> str:
    """The same in DuckDB's SQL: all windows as text, counted, and what they cover."""
    pattern = r"[^\x20\x09-\x0D]+"
    return f"""WITH split AS MATERIALIZED (
    SELECT row_number() OVER () AS row, doc_id, {sql_words("text", pattern)} AS w FROM documents),
windows AS MATERIALIZED (
    SELECT row, place, array_to_string(w[place : place + {window - 1}], ' ') AS text
    FROM split, unnest(range(1, len(w) - {window - 2})) AS u(place) WHERE len(w) >= {window}),
repeated AS (SELECT text FROM windows GROUP BY text HAVING count(*) > 1),
starts AS (SELECT row, place, 1 AS flag FROM windows SEMI JOIN repeated USING (text)),
words AS (
    SELECT row, place, w[place] AS word FROM split, unnest(range(1, len(w) + 1)) AS u(place)),
covered AS (
    SELECT row, place, word, coalesce(max(flag) OVER (
        PARTITION BY row ORDER BY place ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW), 0) AS gone
    FROM words LEFT JOIN starts USING (row, place)),
left_over AS (
    SELECT row, CAST(sum(gone) AS BIGINT) AS removed,
        string_agg(word, ' ' ORDER BY place) FILTER (WHERE gone = 0) AS text
    FROM covered GROUP BY row)
SELECT doc_id, len(w) AS n_words, coalesce(removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM split LEFT JOIN left_over USING (row)"""


def brute_force(rows: list[tuple], window: int = 35) -> list[tuple]:
    """The same from a table of all windows, for tests."""
    count: dict[tuple, int] = {}
    split = [(key, words_of(text and text.encode())) for key, text in rows]
    for _, words in split:
        for at in range(len(words) - window + 1):
            own = tuple(words[at : at + window])
            count[own] = count.get(own, 0) + 1
    out = []
    for key, words in split:
        gone = set()
        for at in range(len(words) - window + 1):
            if count[tuple(words[at : at + window])] > 1:
                gone.update(range(at, at + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((key, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return out
