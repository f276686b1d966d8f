"""Exact n-gram Jaccard join by signature trees.

Two documents link when their sets of word shingles have a Jaccard similarity
of at least a threshold. Documents with one set of shingles are one class; the
join runs over classes.

1. Candidates. All shingles have one order: by hash, with those that many
   documents share last. Sets of a similarity t share a shingle among the first
   ``n - ceil(t n) + 1`` of each, so classes meet in a bucket for each such
   shingle. Shared passages come last in the order and so hardly ever decide.
2. Signature trees. Each class has a bitmap of its shingles, with some bits for
   each shingle. In a bucket, classes are ordered by size and put in a tree whose
   nodes hold the OR and the AND of their bitmaps and the range of sizes. A dual
   traversal drops pairs of nodes whose largest possible overlap is too small;
   what is left is tested class by class with the same bound, and only a
   spanning forest of what is possible leaves the bucket: not all pairs. A
   shingle with more classes than a bucket holds is not gathered. Where it stands
   in the order of each set and how large the sets are bounds what two of them
   can share from there on; it ties only classes of sizes and places that can
   link, so texts of one form that differ enough are not tied at all.
3. Proof. The forests of all buckets give groups that no link can leave. The
   shingles of each class travel once, to its group, where links are verified
   on whole sets until the group's true components are known. Large groups are
   dealt into blocks over tasks; classes that are still apart then meet each
   block.

The result is exact up to the equality of 64-bit hashes. A document of fewer
words than a shingle has one shingle of all of them; one without words has an
empty set and links with nothing. Repeated rows and equal sets are one class;
a null id never names a component if the component has another one. Texts of any
length are read whole; only id and text are read, whatever other columns there are, and
``keep_first`` gives them all back. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waferlens.llm.common import (
    append_columns,
    fresh_name,
    join_bounded,
    shingle_hashes,
    signed,
    sql_lower,
    sql_words,
    squeezed,
    staged,
    text_bytes,
    unsqueezer,
    word_hashes,
)
from waferlens.llm.components import Forest, components

FAN = 8  # children of a node
SMALL_BUCKET = 32  # up to so many classes a tree saves nothing
PROFILE_ROWS = 4_096  # documents whose shingles are counted together


@dataclass(frozen=True)
class JoinSettings:
    """``numerator / denominator`` is the least Jaccard similarity of a link."""

    shingle: int = 5
    numerator: int = 3
    denominator: int = 4
    # Shingles found at least so often go to the end of the order, rarer ones first; if
    # there are more than that many, the most frequent. Any choice is correct.
    frequent: int = 4
    most_frequent: int = 1_000_000
    # Classes of a bucket; a shingle found more often ties its classes without a bucket.
    bucket_rows: int = 1_024
    # Sizes and places of a hot shingle that are compared pair by pair; one with more, a few
    # hundred sizes by as many places, ties all its classes. It decides no link.
    compared_places: int = 8_192
    # Shingles of a block of a group, which a task works on at a time.
    block_shingles: int = 250_000


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(shingle_hashes(word_hashes(words), min(size, len(words))))


def set_class(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


# What a list of classes is: to be searched, tied as a whole, or a class of a hot shingle.
SEARCHED, TIED, HOT = 0, 1, 2


def coded(sizes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Size of a set and place in it as one negative number."""
    return -((sizes.astype(np.int64) << 31) | places)


def decoded(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return -codes >> 31, -codes & ((1 << 31) - 1)


def prefix_length(count: int, s: JoinSettings) -> int:
    return count + (-s.numerator * count // s.denominator) + 1


def links(left: int, right: int, both: int, s: JoinSettings) -> bool:
    return s.denominator * both >= s.numerator * (left + right - both)


def signature(shingles: np.ndarray) -> np.ndarray:
    """A bitmap of one to two bits for each shingle, as 64-bit words."""
    bits = max(64, 1 << (len(shingles) - 1).bit_length())
    place = shingles & np.uint64(bits - 1)
    flags = np.zeros(bits, np.uint8)
    flags[place.astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").view("<u8").astype(np.uint64)


def bitmap_bytes(shingles: np.ndarray) -> bytes:
    return signature(shingles).astype("<u8").tobytes()


def fold(bitmap: np.ndarray, width: int) -> np.ndarray:
    """The same set in a bitmap of ``width`` words: upper halves go over lower ones."""
    while bitmap.shape[-1] > width:
        half = bitmap.shape[-1] // 2
        bitmap = bitmap[..., :half] | bitmap[..., half:]
    return bitmap


def _ones(bitmaps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(bitmaps).sum(axis=-1, dtype=np.int64)


class Group:
    """Classes ordered by size, with bitmaps of one width for each size class."""

    def __init__(self, sizes: np.ndarray, bitmaps: list[np.ndarray], s: JoinSettings):
        self.sizes, self.bitmaps, self.s = sizes, bitmaps, s
        self.width = np.array([len(b) for b in bitmaps])
        # A partner is at most 1/t times as large, so its bitmap is as wide or twice as wide
        # (more for low thresholds); each width keeps the wider rows folded to it.
        self.tables: dict[int, tuple[int, np.ndarray]] = {}
        for width in np.unique(self.width):
            first = int(np.argmax(self.width == width))
            most = int(sizes[self.width == width].max()) * s.denominator // s.numerator
            last = int(np.searchsorted(sizes, most, "right"))
            self.tables[int(width)] = (
                first,
                np.stack([fold(b, int(width)) for b in bitmaps[first:last]]),
            )
        self.leaves = self._leaf_pairs() if len(sizes) > SMALL_BUCKET else None

    def _fits(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether a set of size ``low`` can link with one of size ``high`` at all."""
        return self.s.denominator * low >= self.s.numerator * high

    def _enough(self, overlap: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        total = self.s.numerator + self.s.denominator
        return total * overlap >= self.s.numerator * sizes

    def _leaf_pairs(self) -> np.ndarray:
        """Dual traversal: which pairs of leaves (``FAN`` rows each) may hold a link."""
        width = int(self.width.min())
        rows = np.stack([fold(b, width) for b in self.bitmaps])
        levels = [(rows, rows, self.sizes, self.sizes)]
        while len(levels[-1][0]) > 1:
            either, every, low, high = levels[-1]
            cuts = np.arange(0, len(either), FAN)
            levels.append(
                (
                    np.bitwise_or.reduceat(either, cuts),
                    np.bitwise_and.reduceat(every, cuts),
                    np.minimum.reduceat(low, cuts),
                    np.maximum.reduceat(high, cuts),
                )
            )
        left = right = np.zeros(1, np.int64)
        for level in range(len(levels) - 1, 0, -1):
            either, every, low, high = levels[level]
            keep = np.zeros(len(left), bool)
            for at in range(0, len(left), 4096):
                a, b = left[at : at + 4096], right[at : at + 4096]
                # What every set of one node has and no set of the other is lost to the overlap.
                lost_a = _ones(every[a] & ~either[b])
                lost_b = _ones(every[b] & ~either[a])
                overlap = np.minimum(high[a] - lost_a, high[b] - lost_b)
                keep[at : at + 4096] = (
                    self._enough(overlap, low[a] + low[b])
                    & self._fits(high[a], low[b])
                    & self._fits(high[b], low[a])
                )
            left, right = left[keep], right[keep]
            if level > 1:
                child = np.arange(FAN)
                a = (left[:, None, None] * FAN + child[:, None]).repeat(FAN, 2).ravel()
                b = (right[:, None, None] * FAN + child[None, :]).repeat(FAN, 1).ravel()
                count = len(levels[level - 1][0])
                real = (a < count) & (b < count) & (a <= b)
                left, right = a[real], b[real]
        count = -(-len(self.sizes) // FAN)
        table = np.zeros((count, count), bool)
        table[left, right] = table[right, left] = True
        return table

    def possible(self, row: int, others: np.ndarray) -> np.ndarray:
        """Those of ``others`` whose bound allows a link with ``row``."""
        if self.leaves is not None:
            others = others[self.leaves[row // FAN][others // FAN]]
        size, sizes = self.sizes[row], self.sizes[others]
        others = others[self._fits(np.minimum(sizes, size), np.maximum(sizes, size))]
        found = []
        for width in np.unique(np.minimum(self.width[others], self.width[row])):
            some = others[np.minimum(self.width[others], self.width[row]) == width]
            first, table = self.tables[int(width)]
            own, theirs = table[row - first], table[some - first]
            sizes = self.sizes[some]
            overlap = np.minimum(size - _ones(own & ~theirs), sizes - _ones(theirs & ~own))
            found.append(some[self._enough(overlap, sizes + size)])
        return np.sort(np.concatenate(found)) if found else others[:0]

    def forest(self, label: np.ndarray, proves=None) -> Iterator[tuple[int, int]]:
        """Edges that join all rows whose labels differ and that are, or may be, linked.

        Without ``proves`` an edge is possible; with it, it is verified. Rows with
        one label count as joined from the start.
        """
        count = len(self.sizes)
        waiting = np.ones(count, bool)
        for start in range(count):
            if not waiting[start]:
                continue
            queue = list(np.flatnonzero(waiting & (label == label[start])))
            waiting[queue] = False
            while queue:
                row = int(queue.pop())
                for other in self.possible(row, np.flatnonzero(waiting)):
                    if waiting[other] and (proves is None or proves(row, int(other))):
                        yield row, int(other)
                        more = np.flatnonzero(waiting & (label == label[other]))
                        waiting[more] = False
                        queue.extend(more)


# --- classes and candidates ------------------------------------------------------


def _sets(batch: pa.RecordBatch, size: int) -> list[np.ndarray]:
    return [shingle_set(text, size) for text in text_bytes(batch.column(1))]


def profile(docs: DataFrame, s: JoinSettings) -> DataFrame:
    """Size, class and bitmap of each document, and, in rows of their own, counts of shingles.

    A row with ``seen`` lists the shingles that came more than once in a batch
    of documents, with their counts: summed up they show the frequent ones.
    """

    def described(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = _sets(batch, s.shingle)
        classes = [set_class(x) if len(x) else None for x in sets]
        # Copies within a batch count once, as they are one class.
        once = dict(zip(classes, sets, strict=True))
        every = np.concatenate([np.empty(0, np.uint64), *once.values()])
        seen, counts = np.unique(every, return_counts=True)
        seen, counts = seen[counts > 1], counts[counts > 1].astype(np.int64)
        rows = len(sets)
        return pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays([batch.column(0).cast(pa.int64()), pa.nulls(1, pa.int64())]),
                pa.array([*map(len, sets), None], pa.int64()),
                pa.array([*classes, None], pa.int64()),
                pa.array([*(bitmap_bytes(x) if len(x) else None for x in sets), None], pa.binary()),
                pa.array([None] * rows + [signed(seen)], pa.list_(pa.int64())),
                pa.array([None] * rows + [counts], pa.list_(pa.int64())),
                pa.concat_arrays([batch.column(2), pa.nulls(1, pa.int64())]),
            ],
            names=["doc_id", "n_shingles", "class", "bitmap", "seen", "counts", "text_key"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, PROFILE_ROWS):
                yield described(whole.slice(at, PROFILE_ROWS))

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(
        run,
        "doc_id long, n_shingles long, class long, bitmap binary,"
        " seen array<long>, counts array<long>, text_key long",
    )


def frequent_shingles(profiled: DataFrame, s: JoinSettings) -> tuple[np.ndarray, np.ndarray]:
    """At most ``most_frequent`` shingles that come often, sorted, and how often.

    They only set the order, so it does not matter which are found.
    """
    counted = (
        profiled.where(F.col("seen").isNotNull())
        .select(F.explode(F.arrays_zip("seen", "counts")).alias("pair"))
        .groupBy(F.col("pair.seen").alias("shingle"))
        .agg(F.sum("pair.counts").cast("int").alias("times"))
        .where(F.col("times") >= s.frequent)
    )
    found = counted.orderBy(F.desc("times"), "shingle").limit(s.most_frequent).toArrow()
    shingles = found.column(0).to_numpy().view(np.uint64)
    order = np.argsort(shingles)
    return shingles[order], found.column(1).to_numpy()[order]


def prefixes(
    docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray], s: JoinSettings
) -> DataFrame:
    """(shingle, size, class) for the first shingles of each set, in the common order.

    A shingle known to come more often than a bucket holds is hot: its size is
    ``coded`` with its place in the set's order.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, times = shared.value
        for whole in batches:
            done: set[int] = set()  # copies within a batch go once
            for at in range(0, whole.num_rows, 512):
                parts, sizes, classes, hot = [], [], [], []
                for shingles in _sets(whole.slice(at, 512), s.shingle):
                    if not len(shingles) or (own := set_class(shingles)) in done:
                        continue
                    done.add(own)
                    if len(often):
                        place = np.minimum(np.searchsorted(often, shingles), len(often) - 1)
                        last = often[place] == shingles
                        rarer = np.argsort(times[place[last]], kind="stable")
                        above = times[place[last]][rarer] > s.bucket_rows
                        above = np.concatenate([np.zeros(len(shingles) - len(above), bool), above])
                        shingles = np.concatenate([shingles[~last], shingles[last][rarer]])
                    else:
                        above = np.zeros(len(shingles), bool)
                    length = prefix_length(len(shingles), s)
                    parts.append(shingles[:length])
                    hot.append(above[:length])
                    sizes.append(len(shingles))
                    classes.append(own)
                if not parts:
                    continue
                lengths = [len(p) for p in parts]
                size = np.repeat(np.array(sizes, np.int64), lengths)
                place = np.concatenate([np.arange(length) for length in lengths])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(np.concatenate(parts))),
                        pa.array(np.where(np.concatenate(hot), coded(size, place), size)),
                        pa.array(np.repeat(np.array(classes, np.int64), lengths)),
                    ],
                    names=["shingle", "size", "class"],
                )

    return docs.mapInArrow(run, "shingle long, size long, class long")


def buckets(prefixed: DataFrame, s: JoinSettings) -> DataFrame:
    """Classes that share a prefix shingle, in lists of bounded length.

    Rows of a shingle come by size, so a list ends where the next size is too
    far. Where it is full, another one goes on with its first class again; such
    lists are ``TIED`` and count as joined as a whole until step 3. The classes
    of a hot shingle go to partitions by class and are listed one by one, as
    shingle, coded size and place, and class.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[bytes] = set()
        out: list[tuple[list[int], int]] = []
        members: list[int] = []
        kind = SEARCHED
        shingle = size = own = None

        def flush() -> None:
            if len(members) > 1:
                key = xxhash.xxh3_128_digest(np.array([*members, kind], np.int64).tobytes())
                if key not in known:
                    if len(known) >= 500_000:
                        known.clear()
                    known.add(key)
                    out.append((members, kind))

        def ready() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[], []]
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.list_(pa.int64())), pa.array(columns[1], pa.int32())],
                names=["members", "kind"],
            )

        for batch in batches:
            keys = batch.column(0).to_numpy()
            # Most shingles have one row; only runs, and the ends of the batch, are looked at.
            same = keys[1:] == keys[:-1]
            look = np.concatenate([[True], same]) | np.concatenate([same, [True]])
            look = look[: len(keys)] | (batch.column(1).to_numpy() < 0)
            rows = (column.to_numpy()[look].tolist() for column in batch.columns)
            for next_shingle, next_size, next_own in zip(*rows, strict=True):
                if next_size < 0:
                    out.append(([next_shingle, next_size, next_own], HOT))
                    continue
                if next_shingle == shingle and next_own == own:
                    continue
                if next_shingle != shingle or s.denominator * size < s.numerator * next_size:
                    flush()
                    members, kind = [], SEARCHED
                elif len(members) >= s.bucket_rows:
                    kind = TIED
                    flush()
                    members = [members[0]]
                members.append(next_own)
                shingle, size, own = next_shingle, next_size, next_own
            yield ready()
        flush()
        yield ready()

    place = F.when(F.col("size") < 0, F.xxhash64("class")).otherwise(F.col("shingle"))
    dealt = prefixed.repartition(place).sortWithinPartitions("shingle", "size", "class")
    return dealt.mapInArrow(run, "members array<long>, kind int").distinct()


def places_that_link(codes: np.ndarray, counts: np.ndarray, s: JoinSettings) -> np.ndarray:
    """For each size and place of a hot shingle the number of its part; -1 if it links with none.

    If the shingle is the first that two sets share, they share at most what
    follows it in either. Parts are what such possible links connect.
    """
    if len(codes) > s.compared_places:
        return np.zeros(len(codes), np.int64)
    sizes, places = decoded(codes)
    rest = sizes - places
    total = s.numerator + s.denominator
    part = np.arange(len(codes))
    alone = np.ones(len(codes), bool)
    for at in range(len(codes)):
        low, high = np.minimum(sizes, sizes[at]), np.maximum(sizes, sizes[at])
        fits = s.denominator * low >= s.numerator * high
        fits &= total * np.minimum(rest, rest[at]) >= s.numerator * (sizes + sizes[at])
        fits[at] &= counts[at] > 1
        if fits.any():
            alone[fits] = alone[at] = False
            joined = np.unique(np.append(part[fits], part[at]))
            part[np.isin(part, joined)] = joined[0]
    return np.where(alone, -1, part)


def hot_ties(lists: DataFrame, s: JoinSettings) -> DataFrame:
    """(left, right): each class of a hot shingle with the part of the shingle that it may link in."""
    member = F.col("members")
    hot = lists.where(F.col("kind") == HOT).select(
        member[0].alias("shingle"), member[1].alias("code"), member[2].alias("class")
    )

    def parts(table: pa.Table) -> pa.Table:
        found = places_that_link(table["code"].to_numpy(), table["rows"].to_numpy(), s)
        return table.drop_columns(["rows"]).append_column("part", pa.array(found))

    counted = hot.groupBy("shingle", "code").agg(F.count(F.lit(1)).alias("rows"))
    # A group has a row for each size and place, however many classes there are.
    linked = counted.groupBy("shingle").applyInArrow(parts, "shingle long, code long, part long")
    linked = staged(linked.where("part >= 0"), "hot-places")
    return join_bounded(hot, linked, ["shingle", "code"], "inner").select(
        F.xxhash64("shingle", "part").alias("left"), F.col("class").alias("right")
    )


# --- whole sets ------------------------------------------------------------------


def class_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(component, class, small): the text, compressed, that stands for each wanted class.

    ``wanted`` has ``class``, ``doc_id``, ``text_key`` and ``component``. Rows meet a
    class by id and hash of the text, so those without an id, or with one id, do not
    meet all classes that have it. A repeated row can give a class once from each task.
    """
    ids = wanted.select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "class", "component"
    ).hint("shuffle_hash")
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    chosen = squeezed(keyed, ("doc_id", "text_key")).join(
        ids, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    )
    return chosen.select("component", "class", "small")


def class_sets(docs: DataFrame, wanted: DataFrame, s: JoinSettings) -> DataFrame:
    """Size, bitmap and shingles of each wanted class, from the text that stands for it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = unsqueezer()
        done: set[int] = set()  # of repeated rows one is enough
        for batch in batches:
            rows = []
            for component, own, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own in done:
                    continue
                found = shingle_set(unpack(blob), s.shingle)
                if len(found) and set_class(found) == own:
                    done.add(own)
                    shingles = found.astype("<u8").tobytes()
                    rows.append((component, own, len(found), bitmap_bytes(found), shingles))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)],
                names=["component", "class", "size", "bitmap", "shingles"],
            )

    return class_texts(docs, wanted).mapInArrow(
        run, "component long, class long, size int, bitmap binary, shingles binary"
    )


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple]:
    """(key, rows) of consecutive rows with equal first ``keys`` columns, across batches."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if row[:keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:keys], []
            rows.append(row[keys:])
    if rows:
        yield key, rows


def _group(rows: list[tuple], s: JoinSettings) -> tuple[list[tuple], Group]:
    """Rows (class, size, bitmap, ...) once each by size, and their group."""
    rows = sorted({row[0]: row for row in rows}.values(), key=lambda row: (row[1], row[0]))
    sizes = np.array([row[1] for row in rows], np.int64)
    bitmaps = [np.frombuffer(row[2], "<u8").astype(np.uint64) for row in rows]
    return rows, Group(sizes, bitmaps, s)


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    left, right = zip(*pairs, strict=True) if pairs else ((), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["left", "right"]
    )


def possible_edges(lists: DataFrame, classes: DataFrame, s: JoinSettings) -> DataFrame:
    """A spanning forest of the possible links of every bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: set[tuple[int, int]] = set()
        for _, found in _runs(batches, 1):
            rows, group = _group(found, s)
            label = np.arange(len(rows))
            pairs.update((rows[a][0], rows[b][0]) for a, b in group.forest(label))
            if len(pairs) > 100_000:
                yield _edges(list(pairs))
                pairs.clear()
        yield _edges(list(pairs))

    rows = lists.where(F.col("kind") == SEARCHED).select(
        F.xxhash64("members").alias("bucket"), F.explode("members").alias("class")
    )
    whole = lists.where(F.col("kind") == TIED).select(
        F.col("members")[0].alias("left"), F.explode("members").alias("right")
    )
    dealt = (
        rows.join(classes.select("class", "size", "bitmap"), "class")
        .select("bucket", "class", "size", "bitmap")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
    )
    searched = dealt.mapInArrow(run, "left long, right long")
    return searched.union(whole).union(hot_ties(lists, s)).distinct()


def _proof(rows: list[tuple], group: Group, label: np.ndarray, s: JoinSettings):
    sets: dict[int, np.ndarray] = {}

    def of(row: int) -> np.ndarray:
        if row not in sets:
            sets[row] = np.frombuffer(rows[row][3], "<u8")
        return sets[row]

    def proves(left: int, right: int) -> bool:
        a, b = of(left), of(right)
        if len(a) > len(b):
            a, b = b, a
        place = np.minimum(np.searchsorted(b, a), len(b) - 1)
        return links(len(a), len(b), int((b[place] == a).sum()), s)

    return [(rows[a][0], rows[b][0]) for a, b in group.forest(label, proves)]


def in_blocks(sets: DataFrame, s: JoinSettings) -> DataFrame:
    """Add ``block``: groups of more than ``block_shingles`` are dealt into several.

    The smallest class of a group goes to all its blocks, so that classes
    linked with it are found together whatever their block.
    """
    groups = staged(
        sets.groupBy("component").agg(
            F.ceil(F.sum(F.col("size").cast("long")) / s.block_shingles).cast("int").alias("blocks"),
            F.min("class").alias("first"),
        ),
        "group-sizes",
    )
    several = groups.where(F.col("blocks") > 1)
    spread = F.sequence(F.lit(0), F.col("blocks") - 1)
    own = F.array(F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    block = F.when(F.col("class") == F.col("first"), spread).when(F.col("blocks") > 1, own)
    dealt = join_bounded(sets, staged(several, "large-groups"), ["component"], "left")
    return dealt.withColumn("block", F.explode(F.coalesce(block, F.array(F.lit(0))))).drop(
        "blocks", "first"
    )


def proven_blocks(sets: DataFrame, s: JoinSettings) -> DataFrame:
    """Verified links inside blocks of a group, and the block of each class.

    ``sets`` has (component, class, size, bitmap, shingles). A row with ``right``
    is a link; one without tells the block of class ``left``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for (component, block), found in _runs(batches, 2):
            rows, group = _group(found, s)
            links_found = _proof(rows, group, np.arange(len(rows)), s)
            out += [(component, block, a, b, None) for a, b in links_found]
            out += [(component, block, row[0], None, row[1]) for row in rows]
            if len(out) > 50_000:
                yield _blocks(out)
                out = []
        yield _blocks(out)

    dealt = (
        in_blocks(sets, s)
        .select("component", "block", "class", "size", "bitmap", "shingles")
        .repartition("component", "block")
        .sortWithinPartitions("component", "block")
    )
    return dealt.mapInArrow(run, "component long, block int, left long, right long, size int")


def _blocks(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 5
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)],
        names=["component", "block", "left", "right", "size"],
    )


def links_between_blocks(
    placed: DataFrame, labels: DataFrame, sets: DataFrame, s: JoinSettings
) -> DataFrame:
    """Verified links between classes of several blocks of a group that are still apart.

    ``placed`` has (component, block, class, size), ``labels`` (class, label).
    Most classes of a group have one label by now. Of two classes that are
    apart, one has another label, so each block meets only those others, which
    are dealt into parts like blocks.
    """
    rows = staged(
        placed.join(labels, "class", "left").withColumn("label", F.coalesce("label", "class")),
        "block-labels",
    )
    main = (
        rows.groupBy("component", "label")
        .agg(F.count(F.lit(1)).alias("rows"))
        .groupBy("component")
        .agg(F.max(F.struct("rows", "label"))["label"].alias("main"))
    )
    apart = rows.join(main, "component").where(F.col("label") != F.col("main")).drop("main", "block")
    apart = staged(apart.distinct(), "apart")
    parts = apart.groupBy("component").agg(
        F.ceil(F.sum(F.col("size").cast("long")) / s.block_shingles).cast("int").alias("parts")
    )
    blocks = rows.groupBy("component").agg((F.max("block") + 1).alias("blocks"))
    shape = staged(parts.join(blocks, "component"), "block-shape")
    counted = rows.join(shape, "component")
    columns = ["component", "block", "part", "class", "label"]
    ours = counted.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    others = (
        apart.join(shape, "component")
        .withColumn("part", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    shipped = (
        ours.select(columns)
        .union(others.select(columns))
        .distinct()
        .join(sets, "class")
        .select("component", "block", "part", "class", "size", "bitmap", "shingles", "label")
        .repartition("component", "block", "part")
        .sortWithinPartitions("component", "block", "part")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found in _runs(batches, 3):
            rows, group = _group(found, s)
            label = np.array([row[4] for row in rows], np.int64)
            yield _edges(_proof(rows, group, label, s))

    return shipped.mapInArrow(run, "left long, right long")


# --- the join --------------------------------------------------------------------


def link_classes(docs: DataFrame, profiled: DataFrame, s: JoinSettings) -> DataFrame:
    """(class, label) of all classes that have a link; linked ones share a label."""
    frequent = frequent_shingles(profiled, s)
    lists = staged(buckets(prefixes(docs, frequent, s), s), "buckets")
    classes = staged(
        profiled.where(F.col("class").isNotNull())
        .groupBy("class")
        .agg(
            # Rows with an id first.
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("stands"),
            F.first("n_shingles").cast("int").alias("size"),
            F.first("bitmap").alias("bitmap"),
        )
        .select("class", "stands.doc_id", "stands.text_key", "size", "bitmap"),
        "classes",
    )
    groups = staged(components(possible_edges(lists, classes, s)), "groups")
    wanted = classes.select("class", "doc_id", "text_key").join(groups.withColumnRenamed("node", "class"), "class")
    sets = staged(class_sets(docs, wanted, s), "class-sets")
    proven = staged(proven_blocks(sets, s), "proven")
    found = proven.where(F.col("right").isNotNull()).select("left", "right")
    labels = staged(components(found), "labels").toDF("class", "label")

    several = proven.groupBy("component").agg(F.max("block").alias("last")).where(F.col("last") > 0)
    several = staged(several.select("component"), "large-groups")
    if several.isEmpty():
        return labels
    placed = (
        proven.where(F.col("right").isNull())
        .select("component", "block", F.col("left").alias("class"), "size")
        .join(several, "component", "left_semi")
    )
    more = links_between_blocks(placed, labels, sets.drop("component"), s)
    joined = labels.select(F.col("class").alias("left"), F.col("label").alias("right")).union(more)
    return staged(components(joined), "labels").toDF("class", "label")


def labelled_rows(docs: DataFrame, s: JoinSettings) -> DataFrame:
    """For each row of ``docs`` its id, set size, class, the label and id of its component.

    Rows with empty sets have no class and no label, and are their own component.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    profiled = staged(profile(plain, s), "profile")
    rows = profiled.where(F.col("seen").isNull()).select("doc_id", "n_shingles", "class")
    labels = link_classes(plain, profiled, s)
    classes = rows.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("doc_id").alias("low"))
    labelled = staged(classes.join(labels, "class", "left"), "labelled")
    # Most classes are alone; those of a large component are dealt over tasks.
    linked = labelled.where(F.col("label").isNotNull())
    lowest = staged(linked.groupBy("label").agg(F.min("low").alias("component_id")), "lowest")
    alone = labelled.where(F.col("label").isNull())
    named = staged(
        join_bounded(linked, lowest, ["label"], "inner")
        .select("class", "label", "component_id")
        .union(alone.select("class", F.col("class").alias("label"), F.col("low").alias("component_id"))),
        "named",
    )
    linked = rows.where(F.col("class").isNotNull()).join(named, "class")
    columns = ["doc_id", "n_shingles", "class", "label", "component_id"]
    empty = rows.where(F.col("class").isNull()).select(
        "doc_id", "n_shingles", "class", F.lit(None).cast("long").alias("label"),
        F.col("doc_id").alias("component_id"),
    )
    return linked.select(columns).union(empty)


def near_duplicates(docs: DataFrame, settings: JoinSettings | None = None) -> DataFrame:
    """One row for each row of ``docs`` (``doc_id``, ``text``): size of its set, component."""
    return labelled_rows(docs, settings or JoinSettings()).select(
        "doc_id", "n_shingles", "component_id"
    )


def sql(shingle: int = 5, numerator: int = 75, denominator: int = 100) -> str:
    """The same in DuckDB's SQL: common shingles of every two sets, and what links reach."""
    pattern = r"[^\x20\x09-\x0D]+"
    grams = f"list_transform(range(1, len(w) - {shingle - 2}), lambda i: array_to_string(w[i : i + {shingle - 1}], ' '))"
    return f"""WITH RECURSIVE split AS (
    SELECT row_number() OVER () AS row, doc_id, {sql_words(sql_lower("text"), pattern)} AS w FROM documents),
sets AS MATERIALIZED (
    SELECT row, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {shingle} THEN [array_to_string(w, ' ')]
        ELSE list_sort(list_distinct({grams})) END AS s
    FROM split),
classes AS MATERIALIZED (
    SELECT row_number() OVER () AS class, s, min(doc_id) AS lowest FROM sets WHERE len(s) > 0 GROUP BY s),
grams AS MATERIALIZED (SELECT class, len(s) AS n, unnest(s) AS gram FROM classes),
links AS MATERIALIZED (
    SELECT a.class AS one, b.class AS other
    FROM grams a JOIN grams b ON a.gram = b.gram AND a.class <> b.class
        AND {denominator} * a.n >= {numerator} * b.n AND {denominator} * b.n >= {numerator} * a.n
    GROUP BY a.class, b.class, a.n, b.n
    HAVING {denominator} * count(*) >= {numerator} * (a.n + b.n - count(*))),
reached AS (
    SELECT class, class AS far FROM classes
    UNION SELECT reached.class, links.other FROM reached JOIN links ON links.one = reached.far),
components AS (
    SELECT reached.class, min(lowest) AS component_id
    FROM reached JOIN classes ON classes.class = reached.far GROUP BY reached.class)
SELECT doc_id, len(sets.s) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM sets LEFT JOIN classes USING (s) LEFT JOIN components USING (class)"""


def keep_first(docs: DataFrame, settings: JoinSettings | None = None) -> DataFrame:
    """One row of each component of ``docs``, with all its columns.

    The row with the component's id stays: if several rows have that id, the
    one with the smallest class, and of equal sets the first by text. Rows with
    empty sets are components of their own and all stay.
    """
    s = settings or JoinSettings()
    light = ["_id", "_class", "_copies"]
    taken = docs.columns
    own_id, own_class, copies = (fresh_name(taken, name) for name in light)
    order = fresh_name(taken, "_order")

    found = labelled_rows(docs, s)
    stands = (
        found.where(F.col("class").isNotNull() & F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("label", "doc_id", "class")
        .agg(F.count(F.lit(1)).alias("copies"))
        .groupBy("label", "doc_id")
        .agg(F.min(F.struct("class", "copies")).alias("first"))
    )
    stands = staged(
        stands.select(
            F.col("doc_id").alias(own_id),
            F.col("first.class").alias(f"{own_class}_"),
            F.col("first.copies").alias(copies),
        ),
        "kept-classes",
    )

    def compute(columns: list[pa.Array]) -> list[pa.Array]:
        sets = (shingle_set(text, s.shingle) for text in text_bytes(columns[0]))
        return [pa.array([set_class(x) if len(x) else None for x in sets], pa.int64())]

    rows = append_columns(docs, ["text"], [T.StructField(own_class, T.LongType())], compute)
    kept = rows.where(F.col(own_class).isNotNull()).join(
        stands.hint("shuffle_hash"),
        F.col("doc_id").cast("long").eqNullSafe(F.col(own_id))
        & (F.col(own_class) == F.col(f"{own_class}_")),
    )
    if stands.where(F.col(copies) > 1).limit(1).count():
        # Several rows of one id and one set, which is the exception.
        window = Window.partitionBy("doc_id", own_class).orderBy("text")
        kept = kept.withColumn(order, F.row_number().over(window)).where(F.col(order) == 1)
    empty = rows.where(F.col(own_class).isNull())
    return kept.select(docs.columns).union(empty.select(docs.columns))
