"""Vector best-fit packing of tokenised documents into sequences.

Documents are tokenised and cut into pieces; pieces are dealt into groups of
bounded size and every group is packed on its own, so the work spreads over
tasks and at most one sequence a group is badly filled. A bin has three
capacities (tokens, documents, attention cost as the sum of squared lengths).
Pieces come longest first; each goes to the open bin that, under all three
limits, leaves the smallest weighted residual norm or gives the largest
weighted dot product of demand and residual.

Defined results: a null text is empty and has just the separator; repeated rows
are packed as often as they occur; an empty table gives no rows. Pieces of one length
go by id and place, bins that are equally good by their number; a text of any length is
tokenised whole. Only id and text are read, whatever other columns there are.
"""

from __future__ import annotations

import heapq
import sys
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waferlens.llm.common import staged, text_bytes

TOKENIZER = "word_bpe_49k.json"
SEPARATOR = 0
# Words whose ids a worker remembers; others are tokenised again when they come.
CACHED_WORDS = 500_000
ROWS_PER_GROUP = 32_768
# Marks that end a word and are a token group of their own after a letter or digit.
END_MARKS = b".,;:!?%&$#*"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class Capacity:
    """Limits of a bin and the weight of each in the choice of a bin."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    rule: str = "residual"  # or "dot"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def little_endian(ids: list[int]) -> bytes:
    values = array("I", ids)
    if sys.byteorder == "big":
        values.byteswap()
    return values.tobytes()


class WordEncoder(dict):
    """Token ids of a text, put together from the ids of its words.

    The tokenizer drops white space and never joins characters across it, so
    the ids of a text are the ids of its words one after the other. It also
    lowers all letters, but it looks for special tokens before that; words
    with the start of one keep their case. The dictionary holds the ids of
    words already seen, as little-endian 32-bit numbers.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)

    def __missing__(self, word: bytes) -> bytes:
        stem = word.rstrip(END_MARKS)
        if stem and len(stem) < len(word) and stem[-1:].isalnum():
            # Put together each time, which leaves more room for stems.
            return self[stem] + self[word[len(stem) :]]
        one = self.tokenizer.encode(word.decode("utf-8"), add_special_tokens=False)
        ids = little_endian(one.ids)
        if len(self) < CACHED_WORDS:
            self[word] = ids
        return ids

    def encode(self, text: bytes) -> bytes:
        words = text.lower().split()
        if b"<|" in text:
            words = [w if b"<|" in w else w.lower() for w in text.split()]
        return b"".join(map(self.__getitem__, words))


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def cut(ids: bytes, most: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of runs of at most ``most`` ids."""
    width = most * 4
    for piece, at in enumerate(range(0, len(ids), width)):
        run = ids[at : at + width]
        yield piece, at // 4, len(run) // 4, zlib.crc32(run)


def token_pieces(
    docs: DataFrame,
    tokens: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    path: str | None = None,
) -> DataFrame:
    """One row for each piece of each document, in the columns of ``PIECES``."""
    path = path or tokenizer_path()
    end = little_endian([SEPARATOR])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                keys, rows = batch.column(0).to_pylist(), []
                for key, text in zip(keys, text_bytes(batch.column(1)), strict=True):
                    ids = encode(text or b"") + end
                    rows.extend((key, *piece) for piece in cut(ids, tokens))
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(columns[0], pa.int64()),
                        pa.array(columns[1], pa.int32()),
                        *(pa.array(column, pa.int64()) for column in columns[2:]),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    chosen = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column))
    return chosen.mapInArrow(run, PIECES)


class Bins:
    """Open bins of one group, found by what they have left."""

    def __init__(self, capacity: Capacity):
        self.capacity = capacity
        # By tokens left: a heap of (attention left, documents left, bin).
        self.levels: list[list] = [[] for _ in range(capacity.tokens + 1)]
        self.open = 0  # bit r: some bin has r tokens left
        self.used: list[int] = []

    def _put(self, tokens: int, attention: int, documents: int, number: int) -> None:
        if tokens and documents:
            heapq.heappush(self.levels[tokens], (attention, documents, number))
            self.open |= 1 << tokens

    def _score(self, left: tuple[int, int, int], need: tuple[int, int, int]) -> float:
        """Smaller is better: the squared norm of what would be left, or minus the dot product."""
        c = self.capacity
        full = (c.tokens, c.documents, c.attention)
        shares = [(x / f, n / f) for x, n, f in zip(left, need, full, strict=True)]
        if c.rule == "dot":
            return -sum(w * x * n for w, (x, n) in zip(c.weights, shares, strict=True))
        return sum(w * (x - n) ** 2 for w, (x, n) in zip(c.weights, shares, strict=True))

    def _tightest(self, level: int, cost: int) -> tuple[int, int, int] | None:
        """Of the bins with ``level`` tokens left the one whose attention just suffices."""
        heap = self.levels[level]
        if heap[0][0] >= cost:
            return heap[0]
        return min((entry for entry in heap if entry[0] >= cost), default=None)

    def _choose(self, length: int, cost: int) -> tuple[int, tuple] | None:
        """(tokens left, bin) of the best bin that has room in every respect.

        Levels come nearest first (fullest last by the dot product); the search
        ends where no further level can score better.
        """
        c, best, best_score = self.capacity, None, float("inf")
        nearest_first = c.rule != "dot"
        mask = self.open >> length
        while mask:
            step = (mask & -mask if nearest_first else mask).bit_length() - 1
            mask &= ~(1 << step)
            if nearest_first and c.weights[0] * (step / c.tokens) ** 2 >= best_score:
                break
            entry = self._tightest(length + step, cost)
            if entry is None:
                continue
            score = self._score((length + step, entry[1], entry[0]), (length, 1, cost))
            if score < best_score:
                best, best_score = (length + step, entry), score
            if not nearest_first:
                break
        return best

    def add(self, length: int) -> tuple[int, int]:
        """(bin, offset) for a piece of ``length`` tokens."""
        cost = length * length
        best = self._choose(length, cost)
        if best is None:
            number, c = len(self.used), self.capacity
            self.used.append(length)
            self._put(c.tokens - length, c.attention - cost, c.documents - 1, number)
            return number, 0
        level, entry = best
        heap = self.levels[level]
        if heap[0] == entry:
            heapq.heappop(heap)
        else:
            heap.remove(entry)
            heapq.heapify(heap)
        if not heap:
            self.open &= ~(1 << level)
        attention, documents, number = entry
        offset = self.used[number]
        self.used[number] += length
        self._put(level - length, attention - cost, documents - 1, number)
        return number, offset


def pack_group(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; the order of the input breaks ties of length."""
    if len(lengths) and int(lengths.max()) > min(capacity.tokens, int(capacity.attention**0.5)):
        raise ValueError("a piece exceeds the capacity of an empty bin")
    bins = Bins(capacity)
    number = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    for at in np.argsort(-lengths, kind="stable"):
        number[at], offset[at] = bins.add(int(lengths[at]))
    return number, offset


def pack_pieces(
    pieces: DataFrame, capacity: Capacity, rows_per_group: int = ROWS_PER_GROUP
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to staged ``pieces`` (columns of ``PIECES``)."""
    groups = max(1, -(-pieces.count() // rows_per_group))

    def pack(table: pa.Table) -> pa.Table:
        order = [(name, "ascending") for name in ("doc_id", "piece", "_row")]
        table = table.sort_by(order)
        number, offset = pack_group(table["length"].to_numpy(), capacity)
        sequence = table["_group"].to_numpy() * (1 << 32) + number
        return (
            table.drop_columns(["_group", "_row"])
            .append_column("sequence_id", pa.array(sequence, pa.int64()))
            .append_column("offset", pa.array(offset, pa.int64()))
        )

    # The place in the staged files spreads rows evenly, repeated ones too.
    dealt = pieces.withColumn("_row", F.monotonically_increasing_id()).withColumn(
        "_group", F.pmod(F.xxhash64("_row"), F.lit(groups))
    )
    return dealt.groupBy("_group").applyInArrow(
        pack, f"{PIECES}, sequence_id long, offset long"
    )


def pack_documents(
    docs: DataFrame,
    capacity: Capacity | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    path: str | None = None,
    rows_per_group: int = ROWS_PER_GROUP,
) -> DataFrame:
    """Tokenise ``docs``, cut what is too long, and pack all pieces into sequences."""
    capacity = capacity or Capacity()
    pieces = token_pieces(docs, capacity.tokens, id_column, text_column, path)
    return pack_pieces(staged(pieces, "pieces"), capacity, rows_per_group)
