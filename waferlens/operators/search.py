"""Text embeddings and exact nearest-neighbour search."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waferlens.functions.columns import snippet
from waferlens.shared import materialise, stage_table

# Neighbours returned by default, and metadata type of untyped documents.
DEFAULT_NEIGHBOURS = 5
UNTYPED = "doc"

DIMENSIONS = 1024
# Up to so many queries are held by every task; more travel to the documents in blocks.
QUERIES_PER_PASS = 1_000
# Documents a task holds while blocks of queries pass by.
ROWS_PER_BLOCK = 50_000
# So many parts of the hits of one query are ranked before all of them are.
MERGE_PARTS = 32
# Up to this many hits are broadcast to the documents they belong to.
BROADCAST_HITS = 1_000_000
# Rows of text worth a task of their own.
TEXTS_PER_TASK = 500
# Words whose place a worker remembers.
CACHED_WORDS = 500_000

# Letters, numbers and underscores.
_WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class TextEncoder:
    """Hashed, inverse-document-frequency weighted, unit-length word vectors."""

    weights: tuple[float, ...]

    @property
    def dimensions(self) -> int:
        return len(self.weights)


def word_slot(word: str, dimensions: int) -> int:
    """The place of a word: the first 32 bits of its MD5, which other engines have too."""
    return int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % dimensions


def word_counts(documents: DataFrame, text: str = "text", dimensions: int = DIMENSIONS) -> DataFrame:
    """All columns of ``documents``, the slots of a text's words and how often each comes."""
    slots: dict[str, int] = {}
    names = documents.columns
    place = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, times = [], []
            for value in batch.column(place).to_pylist():
                counted: Counter[int] = Counter()
                for word, count in Counter(_WORD.findall((value or "").lower())).items():
                    slot = slots.get(word)
                    if slot is None:
                        slot = word_slot(word, dimensions)
                        if len(slots) < CACHED_WORDS:
                            slots[word] = slot
                    counted[slot] += count
                rows = sorted(counted.items())
                found.append([slot for slot, _ in rows])
                times.append([count for _, count in rows])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int32()))],
                names=[*names, "_slots", "_times"],
            )

    fields = [T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("_slots", "_times")]
    return documents.mapInArrow(run, T.StructType([*documents.schema.fields, *fields]))


def _spread(documents: DataFrame) -> DataFrame:
    """Rows over as many tasks as there are cores, where the files have fewer splits."""
    cores = documents.sparkSession.sparkContext.defaultParallelism
    if documents.rdd.getNumPartitions() >= cores:
        return documents
    rows = documents.count()
    return documents.repartition(max(1, min(cores, -(-rows // TEXTS_PER_TASK))))


def _encoder_of(counted: DataFrame, dimensions: int) -> TextEncoder:
    """Weights from the share of documents that have a slot: one row for each slot."""
    total = counted.count()
    rows = counted.select(F.explode("_slots").alias("slot")).groupBy("slot").count().collect()
    having = {row["slot"]: row["count"] for row in rows}
    return TextEncoder(
        tuple(math.log((total + 1) / (having.get(slot, 0) + 1)) for slot in range(dimensions))
    )


def fit_encoder(
    documents: DataFrame, text: str = "text", dimensions: int = DIMENSIONS
) -> TextEncoder:
    return _encoder_of(word_counts(_spread(documents.select(text)), text, dimensions), dimensions)


def _weigh(counted: DataFrame, encoder: TextEncoder, name: str) -> DataFrame:
    """Word counts replaced by the encoder's vector."""
    weights = np.array(encoder.weights)
    names = [c for c in counted.columns if c not in ("_slots", "_times")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                slots, times = batch.column("_slots"), batch.column("_times")
                owner = np.repeat(
                    np.arange(batch.num_rows), pc.list_value_length(slots).to_numpy()
                )
                place = slots.flatten().to_numpy()
                vectors = np.zeros((batch.num_rows, len(weights)))
                vectors[owner, place] = times.flatten().to_numpy() * weights[place]
                norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
                vectors /= np.where(norms > 0, norms, 1.0)[:, None]
                flat = pa.array(vectors.astype(np.float32).ravel())
                ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(weights))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in names), pa.ListArray.from_arrays(ends, flat)],
                    names=[*names, name],
                )

    fields = [counted.schema[c] for c in names]
    vector = T.StructField(name, T.ArrayType(T.FloatType()))
    return counted.mapInArrow(run, T.StructType([*fields, vector]))


def embed_text(documents: DataFrame, encoder: TextEncoder, name: str = "embedding") -> DataFrame:
    """Add ``name``: the encoder's vector of ``text`` as ``array<float>``."""
    return _weigh(word_counts(documents, "text", encoder.dimensions), encoder, name)


def fit_and_embed(
    documents: DataFrame, dimensions: int = DIMENSIONS, name: str = "embedding"
) -> tuple[DataFrame, TextEncoder]:
    """Fit on ``documents`` and add their vectors; words are found and hashed once.

    What is kept in between are slots and counts, a fraction of text and vectors.
    """
    counted = stage_table(word_counts(_spread(documents), "text", dimensions), "word-counts")
    encoder = _encoder_of(counted, dimensions)
    return _weigh(counted, encoder, name), encoder


def embed_with(
    documents: DataFrame,
    load_encoder: Callable[[], Callable[[list[str]], list]],
    text: str = "text",
    name: str = "embedding",
) -> DataFrame:
    """Add vectors of an external encoder, loaded once per task and fed whole batches."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = load_encoder()
        for batch in batches:
            yield pd.Series([list(map(float, v)) for v in encoder(batch.tolist())])

    return documents.withColumn(name, encode(F.col(text)))


def knn_search(
    documents: DataFrame,
    queries: DataFrame,
    k: int = DEFAULT_NEIGHBOURS,
    document_id: str = "id",
    query_id: str = "query_id",
    vector: str = "embedding",
    queries_per_pass: int = QUERIES_PER_PASS,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """(query, rank, document, distance): the k documents of least squared distance per query.

    Exact, for distinct query ids. Up to ``queries_per_pass`` queries go to
    every task as they are and the documents stay where they are. More queries
    are dealt to blocks of documents by a shuffle, and stream past a block a
    task holds; no query passes the driver and the plan does not grow with
    them. Either way k rows for each query and block leave a task, and they
    are ranked in two steps. Equal distances are ordered by document id.
    """
    asked = materialise(queries.select(query_id, vector))
    schema = T.StructType(
        [
            T.StructField(query_id, queries.schema[query_id].dataType),
            T.StructField(document_id, documents.schema[document_id].dataType),
            T.StructField("distance", T.DoubleType()),
        ]
    )
    few = asked.limit(queries_per_pass + 1).count() <= queries_per_pass
    if few:
        rows = asked.collect()
        targets = [(row[query_id], np.array(row[vector], np.float64)) for row in rows]
        found = documents.select(document_id, vector).mapInArrow(
            _nearest_of_few(targets, k, schema), schema
        )
    else:
        found = _nearest_of_blocks(
            documents, asked, k, document_id, query_id, vector, rows_per_block, schema
        )
    return merge_hits(found, k, document_id, query_id)


def merge_hits(
    found: DataFrame, k: int, document_id: str = "id", query_id: str = "query_id"
) -> DataFrame:
    """The k least distances of each query, ranked in two steps, equal ones by document id."""
    by_query = Window.partitionBy(query_id).orderBy("distance", document_id)
    by_part = Window.partitionBy(query_id, "_part").orderBy("distance", document_id)
    parted = found.withColumn("_part", F.pmod(F.xxhash64(document_id), F.lit(MERGE_PARTS)))
    best = parted.withColumn("_place", F.row_number().over(by_part)).where(F.col("_place") <= k)
    ranked = best.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
    return ranked.select(query_id, "rank", document_id, "distance")


def as_matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Vectors of one width as the rows of a matrix."""
    if not pc.all(pc.equal(pc.list_value_length(vectors), width), skip_nulls=False).as_py():
        raise ValueError(f"documents need vectors of {width} numbers like the queries")
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.float64)


def _least(ids: pa.Array, points: np.ndarray, target: np.ndarray, k: int, limit: float) -> pa.Table:
    """The k points nearest to ``target`` and no farther than ``limit``."""
    gaps = points - target
    distance = np.einsum("ij,ij->i", gaps, gaps)
    if len(distance) > k:
        limit = min(limit, np.partition(distance, k - 1)[k - 1])
    near = np.flatnonzero(distance <= limit)
    found = pa.table({"id": ids.take(pa.array(near)), "distance": distance[near]})
    return found.sort_by([("distance", "ascending"), ("id", "ascending")]).slice(0, k)


def _hits(query, found: pa.Table, schema: T.StructType, kind: pa.DataType | None) -> pa.RecordBatch:
    query_id, document_id = schema.names[:2]
    rows = found.combine_chunks().to_batches()[0] if found.num_rows else None
    if rows is None:
        return None
    return pa.RecordBatch.from_arrays(
        [pa.array([query] * rows.num_rows, kind), rows.column(0), rows.column(1)],
        names=[query_id, document_id, "distance"],
    )


def _nearest_of_few(targets: list[tuple], k: int, schema: T.StructType):
    """Task body: fold batches of documents into the k best for each query."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(schema[0].dataType)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[pa.Table | None] = [None] * len(targets)
        for batch in batches:
            if batch.num_rows == 0 or not targets:
                continue
            points = as_matrix(batch.column(1), len(targets[0][1]))
            for place, (_, target) in enumerate(targets):
                kept, limit = best[place], np.inf
                if kept is not None and kept.num_rows == k:
                    limit = kept["distance"][k - 1].as_py()
                found = _least(batch.column(0), points, target, k, limit)
                if found.num_rows:
                    merged = found if kept is None else pa.concat_tables([kept, found])
                    order = [("distance", "ascending"), ("id", "ascending")]
                    best[place] = merged.sort_by(order).slice(0, k)
        for (query, _), kept in zip(targets, best, strict=True):
            if kept is not None:
                yield _hits(query, kept, schema, kind)

    return fold


def _nearest_of_blocks(
    documents: DataFrame,
    asked: DataFrame,
    k: int,
    document_id: str,
    query_id: str,
    vector: str,
    rows_per_block: int,
    schema: T.StructType,
) -> DataFrame:
    """The k best of each block of documents for each query.

    Every block gets all its documents first and then all queries, in batches.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(schema[0].dataType)
    blocks = max(1, -(-documents.count() // rows_per_block))
    held = documents.select(
        F.pmod(F.xxhash64(document_id), F.lit(blocks)).alias("_block"),
        F.lit(0).alias("_kind"),
        F.col(document_id).alias("_document"),
        F.lit(None).cast(schema[0].dataType).alias("_query"),
        F.col(vector).cast("array<double>").alias("_vector"),
    )
    passing = asked.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("_block"),
        F.lit(1).alias("_kind"),
        F.lit(None).cast(schema[1].dataType).alias("_document"),
        F.col(query_id).alias("_query"),
        F.col(vector).cast("array<double>").alias("_vector"),
    )
    dealt = held.union(passing).repartition("_block").sortWithinPartitions("_block", "_kind")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, parts, points = None, [], [], None
        for whole in batches:
            keys = whole.column(0).to_numpy() * 2 + whole.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), whole.num_rows]
            for start, end in zip(cuts, cuts[1:], strict=False):
                if start == end:
                    continue
                rows = whole.slice(start, end - start)
                now, is_query = divmod(int(keys[start]), 2)
                if now != block:
                    block, ids, parts, points = now, [], [], None
                vectors = rows.column("_vector")
                if not is_query:
                    ids.append(rows.column("_document"))
                    parts.append(vectors)
                    continue
                if not parts:
                    continue
                targets = as_matrix(vectors, len(vectors[0]))
                if points is None:
                    documents_here = pa.concat_arrays(ids)
                    points = np.concatenate([as_matrix(p, targets.shape[1]) for p in parts])
                for query, target in zip(rows.column("_query").to_pylist(), targets, strict=True):
                    found = _least(documents_here, points, target, k, np.inf)
                    if found.num_rows:
                        yield _hits(query, found, schema, kind)

    return dealt.mapInArrow(stream, schema)


def search_hits(
    nearest: DataFrame,
    documents: DataFrame,
    document_id: str = "id",
    text: str = "text",
    metadata: str = "metadata",
) -> DataFrame:
    """Nearest rows with document, metadata and the texts a reader is shown."""
    nearest = materialise(nearest)
    few = nearest.count() <= BROADCAST_HITS
    shaped = documents.select(document_id, text, metadata).join(
        F.broadcast(nearest) if few else nearest, document_id
    )
    kind = F.coalesce(F.element_at(F.col(metadata), "type"), F.lit(UNTYPED))
    return shaped.select(
        *[c for c in nearest.columns if c not in (document_id, "distance")],
        F.col(document_id),
        F.col(text).alias("document"),
        F.col(metadata),
        F.col("distance"),
        F.concat(F.lit("["), kind, F.lit("] "), snippet(F.col(text))).alias("headline"),
        F.format_string("%.4f", "distance").alias("distance_text"),
    )


def search(
    index: DataFrame,
    queries: DataFrame,
    encoder: TextEncoder,
    k: int = DEFAULT_NEIGHBOURS,
) -> DataFrame:
    """Hits of text queries (query_id, text) in an index (id, text, metadata, embedding).

    The queries are embedded with the encoder the index was built with. An
    empty index is an error, as there is nothing to search.
    """
    if index.isEmpty():
        raise RuntimeError("no documents to search")
    wanted = embed_text(queries.select("query_id", "text"), encoder)
    return search_hits(knn_search(index, wanted, k), index)
