"""Document fingerprints: the k smallest hashes of a text's shingles.

A sketch is a sorted array of the ``k`` smallest distinct 64-bit hashes of the
runs of five words. Sketches of parts merge into the sketch of the whole: the
smallest of the smallest. From two sketches follow resemblance (the share of
common hashes among the smallest of the union), containment, and from one the
number of distinct shingles; sets of at most ``k`` shingles are exact.

Everything is built from SQL functions. Words are what stands between the
blanks ``\\x20\\x09-\\x0D``, in small letters; a text of fewer than five words has
one shingle of all of them, an empty or null text none. Two empty sketches have
resemblance 1.

For the next document rows are dealt into ranges of ids, whose borders come from
sorting ids alone. Rows of one id follow one another by the hash of their text,
null ids come first, and equal rows are one row with a count until the end, so
neither an id nor a text that a third of all rows have is one range. An empty
table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waferlens.llm.common import staged

SHINGLE = 5
SIZE = 256
# Documents are dealt into ranges of at least so many rows. Beyond so many ranges a range
# may grow to the larger size; beyond that there are more ranges again.
ROWS_PER_RANGE, MANY_RANGES, LARGE_RANGE = 4_096, 10_000, 65_536
# Copies of a row are written out so many at a time.
COPIES_AT_ONCE = 1_000
_TWO_64 = float(1 << 64)


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """A hash for every run of ``size`` words, with repeats."""
    return F.transform(
        F.array(F.transform(words(F.coalesce(text, F.lit(""))), lambda word: F.xxhash64(word))),
        lambda hashes: F.when(
            F.size(hashes) >= size,
            F.transform(
                F.sequence(F.lit(0), F.size(hashes) - size),
                lambda at: F.xxhash64(*(F.get(hashes, at + step) for step in range(size))),
            ),
        )
        .when(F.size(hashes) > 0, F.array(F.xxhash64(hashes)))
        .otherwise(F.array().cast("array<bigint>")),
    )[0]


def sketch(text: Column, size: int = SHINGLE, k: int = SIZE) -> Column:
    """The fingerprint of a text."""
    return F.slice(F.sort_array(F.array_distinct(shingle_hashes(text, size))), 1, k)


def merge(left: Column, right: Column, k: int = SIZE) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(left, right)), 1, k)


def merge_all(parts: DataFrame, keys: list[str], column: str, k: int = SIZE) -> DataFrame:
    """One sketch for each key from the sketches of its parts.

    Parts are unpacked and the smallest hashes of a key kept by rank, so no
    task holds more than ``k`` hashes of a key from any other.
    """
    hashes = parts.select(*keys, F.explode(column).alias("_hash")).distinct()
    ranked = hashes.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy("_hash"))
    ).where(F.col("_rank") <= k)
    return ranked.groupBy(*keys).agg(F.sort_array(F.collect_list("_hash")).alias(column))


def resemblance(left: Column, right: Column, k: int = SIZE) -> Column:
    """Estimated size of the intersection over size of the union."""
    union = F.size(merge(left, right, k))
    both = F.size(F.array_intersect(merge(left, right, k), F.array_intersect(left, right)))
    return F.when(union == 0, F.lit(1.0)).otherwise(both / union)


def distinct_shingles(fingerprint: Column, k: int = SIZE) -> Column:
    """Estimated number of distinct shingles, exact below ``k``."""
    largest = F.get(fingerprint, F.lit(k - 1)).cast("double")
    return F.when(F.size(fingerprint) < k, F.size(fingerprint).cast("double")).otherwise(
        (k - 1) * _TWO_64 / (largest + _TWO_64 / 2)
    )


def containment(left: Column, right: Column, k: int = SIZE) -> Column:
    """Estimated share of the left text's shingles that the right one has."""
    union = distinct_shingles(merge(left, right, k), k)
    own = distinct_shingles(left, k)
    share = resemblance(left, right, k) * union / own
    return F.when(F.size(left) == 0, F.lit(1.0)).otherwise(F.least(share, F.lit(1.0)))


def as_string(fingerprint: Column) -> Column:
    return F.array_join(fingerprint.cast("array<string>"), ",")


def range_count(rows: int, rows_per_range: int = ROWS_PER_RANGE) -> int:
    """How many ranges so many rows are dealt into."""
    fine = -(-rows // rows_per_range)
    coarse = -(-rows // max(rows_per_range, LARGE_RANGE))
    return max(1, min(fine, max(MANY_RANGES, coarse)))


def _constant(values: list, kind: str) -> Column:
    """A list as one constant of the plan, however long it is."""
    return F.from_json(F.lit(json.dumps(values)), kind)


def _place(key: Column, borders: list[tuple]) -> tuple[Column, Column]:
    """The number of the range that a key falls into, and whether it is the range's first key.

    Two short searches instead of one long: the blocks of borders, then one block.
    """
    step = max(1, round(len(borders) ** 0.5))
    rows = [{"id": own, "tie": tie} for own, tie in borders]
    blocks = [rows[at : at + step] for at in range(0, len(rows), step)]
    kind = "array<struct<id: bigint, tie: bigint>>"
    block = F.size(F.filter(_constant([b[0] for b in blocks], kind), lambda b: b <= key)) - 1
    own = F.get(_constant(blocks, f"array<{kind}>"), block)
    inside = F.size(F.filter(own, lambda b: b <= key)) - 1
    return block * step + inside, F.get(own, inside) == key


def with_next(docs: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add ``print``, ``next_text`` and ``next_print``: the latter of the next row by id, then text.

    A row that a range begins with goes to the range before as well, as the
    successor of that range's last row (the very first to the last), so one
    shuffle of the texts finds every successor. Only where ids repeat are equal
    rows counted together, and texts hashed to tell rows of one id apart.
    ``docs`` has ``doc_id``, ``text``.
    """
    repeated = not docs.groupBy("doc_id").count().where("count > 1").isEmpty()
    if repeated:
        docs = staged(docs.groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("_copies")), "rows")
    else:
        docs = docs.withColumn("_copies", F.lit(1).cast("long"))
    tie = F.xxhash64("text") if repeated else F.lit(0).cast("long")
    key = F.struct(F.col("doc_id").alias("id"), tie.alias("tie"))
    ranges = range_count(docs.count(), rows_per_range)
    firsts = (
        docs.select(key.alias("_key"))
        .repartitionByRange(ranges, "_key")
        .groupBy(F.spark_partition_id().alias("_range"))
        .agg(F.min("_key").alias("_key"))
    )
    borders = [tuple(row["_key"]) for row in firsts.collect()]
    borders.sort(key=lambda b: (b[0] is not None, b[0] or 0, b[1]))
    if not borders:
        borders = [(None, 0)]
    place, begins = _place(F.col("_key"), borders)
    own = F.struct(F.col("_place").alias("range"), F.lit(0).alias("role"))
    before = F.struct(
        F.pmod(F.col("_place") - 1, F.lit(len(borders))).alias("range"), F.lit(1).alias("role")
    )
    dealt = (
        docs.withColumn("_key", key)
        .withColumns({"_place": place, "_begins": begins})
        .withColumn("_copy", F.explode(F.when(F.col("_begins"), F.array(own, before)).otherwise(F.array(own))))
        .select("doc_id", "text", "_copies", "_key", F.col("_copy.range").alias("_range"), F.col("_copy.role").alias("_role"))
        .repartition("_range")
    )
    order = Window.partitionBy("_range").orderBy("_role", "_key", "text")
    found = (
        dealt.withColumn("print", sketch(F.col("text")))
        .withColumn("next_text", F.lead("text").over(order))
        .withColumn("next_print", F.lead("print").over(order))
        .where(F.col("_role") == 0)
        .drop("_range", "_role", "_key")
    )
    return _written_out(found, rows_per_range) if repeated else found.drop("_copies")


def _written_out(rows: DataFrame, most: int) -> DataFrame:
    """Each row as often as it was there: all copies but the last are followed by themselves."""
    fixed = staged(rows, "followed")
    many = fixed.agg(F.max("_copies")).first()[0] or 0
    last = F.col("_copies") - 1
    pieces = fixed.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(COPIES_AT_ONCE).cast("long"))))
    if many > most:
        pieces = pieces.repartition(F.xxhash64("doc_id", "print", "_from"))
    upto = F.least(last, F.col("_from") + COPIES_AT_ONCE - 1)
    copies = pieces.withColumn("_copy", F.explode(F.sequence(F.col("_from"), upto)))
    own = F.col("_copy") < last
    return copies.select(
        "doc_id",
        "text",
        "print",
        F.when(own, F.col("text")).otherwise(F.col("next_text")).alias("next_text"),
        F.when(own, F.col("print")).otherwise(F.col("next_print")).alias("next_print"),
    )


def edited(text: Column, following: Column) -> Column:
    """The last quarter of the code points replaced by the start of the next text."""
    count = F.char_length(text)
    gone = F.floor(count / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), count - gone), F.substring(following, F.lit(1), gone))


def fingerprints(docs: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    Rows with the same id follow one another by the hash of their text; every
    row has one result. The row after the last is the first.
    """
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    pairs = with_next(plain, rows_per_range)
    changed = pairs.withColumn("edited", edited(F.col("text"), F.col("next_text")))
    return changed.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "print",
        "next_print",
        sketch(F.col("edited")).alias("edited_print"),
    ).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_string(F.col("print")).alias("fingerprint"),
        as_string(F.col("edited_print")).alias("edited_fingerprint"),
        resemblance(F.col("print"), F.col("edited_print")).alias("near_edited"),
        resemblance(F.col("print"), F.col("next_print")).alias("near_next"),
    )
