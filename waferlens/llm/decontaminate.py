"""Benchmark decontamination by a prefix-filtered join of item windows.

Words are ordered by rarity in the benchmark. Any window of an item contains
its own rarest word, so that word is a sufficient prefix: a document can hold
the window only where it holds that word. Documents are joined on these prefix
words; each meeting aligns one document position with one item position, where
length and position bound how far the two can agree, and the words around are
compared one by one. Nothing is decided by a hash.

The benchmark is dealt into blocks of bounded size. Each block is broadcast and
joined in a pass of its own over the same task's rows, so the documents are
never shuffled, and a benchmark of any size fits: a few passes run one after the
other in a task, and where there are more, rows are written out in between.

Defined results: a null text has no words and is clean; a null item is skipped;
an item without an id counts under the empty id; items with the same id count
once; repeated documents are judged each; an empty benchmark hits nothing. Of windows
with two words equally rare the smaller word is the prefix; texts of any length are
read whole; columns of ``docs`` stay, and names of results that clash are the caller's
to choose. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waferlens.llm.common import append_columns, fresh_name, sql_lower, sql_words, staged, text_bytes

WINDOW = 10
# Text of the benchmark in a block, in bytes, which takes about ten times that in memory,
# and how many blocks a task goes through, each in a worker of its own.
BLOCK_BYTES = 4 << 20
PASSES = 4

# Letters A-Z become small; other bytes below 0x80 but digits and small letters part words.
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20
    for c in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


class Items:
    """A block of benchmark items, found by the rarest word of each window."""

    def __init__(self, rows: list[tuple[str, bytes]], window: int):
        self.items = [(key, words) for key, text in rows if (words := words_of(text))]
        self.window = window
        count = Counter(word for _, words in self.items for word in words)
        self.places: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for number, (_, words) in enumerate(self.items):
            length = min(window, len(words))
            rank = [(count[word], word) for word in words]
            anchors = {
                min(range(at, at + length), key=rank.__getitem__)
                for at in range(len(words) - length + 1)
            }
            for place in anchors:
                self.places[words[place]].append((number, place))
        self.places = dict(self.places)

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Ranges of hit words (possibly overlapping) and the ids of items with a hit."""
        places, total = self.places, len(words)
        ranges, found = [], set()
        for at, word in enumerate(words):
            if word not in places:
                continue
            for number, place in places[word]:
                key, item = self.items[number]
                length = min(self.window, len(item))
                # A window holding this word starts at most so far before it and ends so far after.
                before = min(length - 1, place, at)
                after = min(length - 1, len(item) - 1 - place, total - 1 - at)
                if before + after + 1 < length:
                    continue
                left = 0
                while left < before and words[at - left - 1] == item[place - left - 1]:
                    left += 1
                right = 0
                while right < after and words[at + right + 1] == item[place + right + 1]:
                    right += 1
                if left + right + 1 >= length:
                    ranges.append((at - left, at + right + 1))
                    found.add(key)
        return ranges, found


def item_blocks(
    benchmark: DataFrame, id_column: str, text_column: str, block_bytes: int
) -> Iterator[list[tuple[str, bytes]]]:
    """The items in blocks of about ``block_bytes``, one at a time: the sizes are summed first.

    Copies of an item are one, so that blocks dealt by hash are even.
    """
    items = benchmark.where(F.col(text_column).isNotNull()).select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("key"),
        F.col(text_column).alias("words"),
    ).distinct()
    size = items.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    for number in range(blocks):
        dealt = items.where(F.pmod(F.xxhash64("key", "words"), F.lit(blocks)) == number)
        yield [(row.key, row.words.encode()) for row in dealt.collect()]


def flag_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    passes: int = PASSES,
    names: tuple[str, str, str] = ("n_words", "hits", "items"),
) -> DataFrame:
    """All columns of ``docs``, the number of words, hit ranges and hit items.

    ``hits`` holds (start, end) of disjoint ranges of words, in order, as one
    flat list; ``items`` the ids of items with an occurring window, sorted.
    """
    session = docs.sparkSession
    fields = [
        T.StructField(names[0], T.LongType()),
        T.StructField(names[1], T.ArrayType(T.LongType())),
        T.StructField(names[2], T.ArrayType(T.StringType())),
    ]

    def merged(ranges: list[tuple[int, int]]) -> list[int]:
        flat: list[int] = []
        for start, end in sorted(ranges):
            if flat and start <= flat[-1]:
                flat[-1] = max(flat[-1], end)
            else:
                flat += (start, end)
        return flat

    own = [fresh_name(docs.columns, f"_{name}") for name in names]
    result = docs
    for number, rows in enumerate(item_blocks(benchmark, item_id, item_text, block_bytes)):
        block = session.sparkContext.broadcast(rows)
        cache: dict[str, Items] = {}

        def compute(columns, block=block, cache=cache):
            if "items" not in cache:
                cache["items"] = Items(block.value, window)
            items, out = cache["items"], ([], [], [])
            earlier = [column.to_pylist() for column in columns[1:]]
            for row, text in enumerate(text_bytes(columns[0])):
                words = words_of(text)
                ranges, found = items.find(words)
                if earlier:
                    flat = earlier[0][row]
                    ranges += zip(flat[::2], flat[1::2], strict=True)
                    found.update(earlier[1][row])
                out[0].append(len(words))
                out[1].append(merged(ranges))
                out[2].append(sorted(found))
            return [
                pa.array(out[0], pa.int64()),
                pa.array(out[1], pa.list_(pa.int64())),
                pa.array(out[2], pa.list_(pa.string())),
            ]

        # What earlier passes found goes in, and is replaced by what is known now.
        before = own[1:] if number else []
        now = [f"{name}_" for name in own]
        named = [T.StructField(n, f.dataType) for n, f in zip(now, fields, strict=True)]
        result = append_columns(result, [text_column, *before], named, compute).select(
            *docs.columns, *(F.col(n).alias(o) for n, o in zip(now, own, strict=True))
        )
        if number % passes == passes - 1:
            result = staged(result, "contamination")
    return result.select(*docs.columns, *(F.col(o).alias(n) for o, n in zip(own, names, strict=True)))


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row for each document: words, hit words, items hit, and a digest of their ids."""
    found = flag_contaminated(docs.select("doc_id", "text"), benchmark, **options)
    steps = F.transform(
        F.sequence(F.lit(0), F.lit(1)), lambda part: F.filter("hits", lambda _, i: i % 2 == part)
    )
    total = lambda values: F.aggregate(values, F.lit(0).cast("long"), lambda a, b: a + b)
    n_hit = total(steps[1]) - total(steps[0])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def sql(window: int = WINDOW) -> str:
    """The same in DuckDB's SQL: all windows of both sides, joined as text."""
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    words = sql_words(sql_lower("text"), pattern)
    return f"""WITH split AS MATERIALIZED (
    SELECT row_number() OVER () AS row, doc_id, {words} AS w FROM documents),
items AS (
    SELECT item_id, w, least({window}, len(w)) AS size FROM (SELECT item_id, {words} AS w FROM benchmark)),
windows AS MATERIALIZED (
    SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item, size,
        array_to_string(w[place : place + size - 1], ' ') AS text
    FROM items, unnest(range(1, len(w) - size + 2)) AS u(place) WHERE size > 0),
places AS (
    SELECT row, place, size, array_to_string(w[place : place + size - 1], ' ') AS text
    FROM split, (SELECT DISTINCT size FROM windows) AS sizes, unnest(range(1, len(w) - size + 2)) AS u(place)),
found AS MATERIALIZED (SELECT row, place, size, item FROM places JOIN windows USING (size, text)),
hit AS (
    SELECT row, count(DISTINCT place + step) AS n FROM found, unnest(range(size)) AS u(step) GROUP BY row),
named AS (
    SELECT row, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT row, item FROM found) GROUP BY row)
SELECT doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, hit.n IS NOT NULL AS contaminated
FROM split LEFT JOIN hit USING (row) LEFT JOIN named USING (row)"""


def brute_force(docs: list[tuple], items: list[tuple], window: int = WINDOW) -> list[tuple]:
    """The same by comparing every window with every place, for tests."""
    out = []
    for key, text in docs:
        words, hit, found = words_of(text and text.encode()), set(), set()
        for item, item_text in items:
            own = words_of(item_text and item_text.encode())
            length = min(window, len(own))
            for at in range(len(own) - length + 1 if own else 0):
                for place in range(len(words) - length + 1):
                    if words[place : place + length] == own[at : at + length]:
                        hit.update(range(place, place + length))
                        found.add("" if item is None else str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((key, len(words), len(hit), len(found), digest, bool(hit)))
    return out
