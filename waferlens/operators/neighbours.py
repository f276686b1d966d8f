"""Approximate nearest neighbours: random-projection hash tables, exact distances.

The opt-in next to ``search.knn_search``. In each of a few tables a vector's
bucket is given by the sides of random planes it lies on. Documents go to their
bucket of each table; a query goes to the buckets most likely to hold its
neighbours, by how near it is to the planes. Where they meet, by an equi-join
on the bucket, distances are exact, and the best of all buckets are ranked.

How many buckets a query looks into is measured before: among a bounded sample
of documents the true neighbours of sampled queries must be found in the wanted
share of cases. Neighbours in a sample are farther away than those among all
documents, so the share found in the end is rather larger. The nearer to
uniform the vectors are, the more buckets that takes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waferlens.operators.search import DEFAULT_NEIGHBOURS, as_matrix, knn_search, merge_hits
from waferlens.shared import materialise, stage_table

TABLES = 4
# Documents a bucket should hold on average, and the most planes of a table: a query
# weighs all of a table's buckets, so there are at most 16,384.
BUCKET_ROWS = 512
MOST_PLANES = 14
# Share of the sample's true neighbours that must be found.
WANTED_RECALL = 0.95
SAMPLE_DOCUMENTS, SAMPLE_QUERIES = 4_000, 200
SEED = 42
# A cell of a hot bucket holds about so many documents, and is passed by so many queries.
ROWS_PER_CELL, QUERIES_PER_CELL = 20_000, 20_000
# Hits a task folds together at a time, and hands on when they are still as many.
HITS_AT_ONCE = 500_000
# Numbers in the gaps between vectors that are held at a time, even if all are equally near.
NUMBERS_AT_ONCE = 1 << 24


@dataclass(frozen=True)
class HashTables:
    """Planes (tables x planes x width) through ``centre``, and the buckets a query looks into."""

    planes: np.ndarray
    centre: np.ndarray
    probes: int

    @property
    def buckets(self) -> int:
        """Buckets of one table."""
        return 1 << self.planes.shape[1]

    def sides(self, vectors: np.ndarray) -> np.ndarray:
        """Distance and side from each plane: vectors x tables x planes."""
        return np.einsum("nw,tpw->ntp", vectors - self.centre, self.planes)

    def keys(self, sides: np.ndarray) -> np.ndarray:
        """The bucket in each table: vectors x tables."""
        return (sides > 0) @ (1 << np.arange(sides.shape[2]))

    def costs(self, sides: np.ndarray) -> np.ndarray:
        """How far a vector is from every bucket of each table: vectors x tables x buckets.

        The squared distances to the planes that have to be crossed.
        """
        bits = np.arange(self.buckets)[:, None] >> np.arange(sides.shape[2]) & 1
        inside, outside = np.where(sides > 0, sides, 0) ** 2, np.where(sides > 0, 0, sides) ** 2
        return inside @ (1 - bits).T + outside @ bits.T

    def probed(self, vectors: np.ndarray) -> np.ndarray:
        """The nearest buckets of each table, numbered over all: vectors x (tables x probes)."""
        costs = self.costs(self.sides(vectors))
        most = min(self.probes, self.buckets)
        near = np.argpartition(costs, most - 1, axis=2)[:, :, :most]
        return (near + self._first()[:, None]).reshape(len(vectors), -1)

    def home(self, vectors: np.ndarray) -> np.ndarray:
        """The bucket in each table, numbered over all."""
        return self.keys(self.sides(vectors)) + self._first()

    def _first(self) -> np.ndarray:
        return np.arange(len(self.planes)) * self.buckets


def _sample(df: DataFrame, key: str, vector: str, rows: int) -> np.ndarray:
    """The vectors of the rows whose hashed keys come first: the same on any cluster."""
    chosen = df.where(F.col(vector).isNotNull()).orderBy(F.xxhash64(key), key).limit(rows)
    return np.array([row[0] for row in chosen.select(vector).collect()], np.float64)


def fit_tables(
    documents: DataFrame,
    queries: DataFrame,
    k: int = DEFAULT_NEIGHBOURS,
    document_id: str = "id",
    query_id: str = "query_id",
    vector: str = "embedding",
    tables: int = TABLES,
    bucket_rows: int = BUCKET_ROWS,
    recall: float = WANTED_RECALL,
    seed: int = SEED,
) -> HashTables | None:
    """Tables for these documents and queries; None if either has no rows.

    Planes come from the seed; their number from the number of documents, the
    centre and the number of probes from bounded samples.
    """
    rows = documents.count()
    sample = _sample(documents, document_id, vector, SAMPLE_DOCUMENTS)
    asked = _sample(queries, query_id, vector, SAMPLE_QUERIES)
    if not len(sample) or not len(asked):
        return None
    planes = min(MOST_PLANES, max(1, math.ceil(math.log2(max(2, rows / bucket_rows)))))
    drawn = np.random.default_rng(seed).standard_normal((tables, planes, sample.shape[1]))
    found = HashTables(drawn / np.linalg.norm(drawn, axis=2, keepdims=True), sample.mean(axis=0), 1)
    ranks = []
    homes = found.keys(found.sides(sample))
    for target in asked:
        gaps = sample - target
        distance = np.einsum("ij,ij->i", gaps, gaps)
        distance[distance == 0] = np.inf  # the query itself is found anyway
        near = np.argsort(distance, kind="stable")[:k]
        costs = found.costs(found.sides(target[None]))[0]
        own = np.take_along_axis(costs, homes[near].T, axis=1)
        ranks.append((costs[:, None, :] < own[:, :, None]).sum(axis=2).min(axis=0))
    probes = int(np.quantile(np.concatenate(ranks), recall, method="higher")) + 1
    return HashTables(found.planes, found.centre, min(probes, found.buckets))


def _bucketed(
    df: DataFrame, key: str, vector: str, tables: HashTables, probing: bool, with_vectors: bool
) -> DataFrame:
    """A row for each bucket of each vector: (_bucket, _key, and the vector if wanted)."""
    width = tables.planes.shape[2]
    fields = [T.StructField("_bucket", T.LongType()), T.StructField("_key", df.schema[key].dataType)]
    if with_vectors:
        fields.append(T.StructField("_vector", T.ArrayType(T.DoubleType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = 256 if probing else 4096
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                vectors = as_matrix(batch.column(1), width)
                buckets = tables.probed(vectors) if probing else tables.home(vectors)
                row = pa.array(np.repeat(np.arange(len(vectors)), buckets.shape[1]))
                columns = [pa.array(buckets.ravel(), pa.int64()), batch.column(0).take(row)]
                if with_vectors:
                    columns.append(batch.column(1).take(row))
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    chosen = df.select(F.col(key), F.col(vector).cast("array<double>"))
    return chosen.where(F.col(vector).isNotNull()).mapInArrow(run, T.StructType(fields))


def _cells(documents: DataFrame, asked: DataFrame) -> DataFrame:
    """Buckets that queries look into, and the parts that their two sides are split into.

    At most one row for each bucket there is, a number fixed by the tables.
    """
    held = documents.groupBy("_bucket").agg(F.count("*").alias("_rows"))
    passing = asked.groupBy("_bucket").agg(F.count("*").alias("_queries"))
    parts = lambda count, most: F.ceil(F.col(count) / most).cast("int")
    return stage_table(
        held.join(passing, "_bucket").select(
            "_bucket",
            parts("_rows", ROWS_PER_CELL).alias("_documents"),
            parts("_queries", QUERIES_PER_CELL).alias("_queries"),
        ),
        "buckets",
    )


def _dealt(rows: DataFrame, cells: DataFrame, own: str, other: str, kind: int) -> DataFrame:
    """Rows in the cells of their bucket: in one part of their side, for all parts of the other."""
    every: Column = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
    part = F.pmod(F.xxhash64("_key"), F.col(own)).cast("int")
    return (
        rows.join(F.broadcast(cells), "_bucket")
        .select("_bucket", part.alias("_mine"), every.alias("_theirs"), "_key", "_vector")
        .select(
            "_bucket",
            F.col("_theirs" if kind else "_mine").alias("_documents"),
            F.col("_mine" if kind else "_theirs").alias("_queries"),
            F.lit(kind).alias("_kind"),
            F.col("_key").alias("_query" if kind else "_document"),
            "_vector",
        )
    )


def _fold(hits: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest documents of each query, each once."""
    ordered = hits.sort_values(["query", "distance", "id"], kind="stable")
    return ordered.drop_duplicates(["query", "id"]).groupby("query", sort=False).head(k)


def _near_pairs(held: np.ndarray, asked: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, document, distance) of the k nearest documents of each query, ties in their order.

    A matrix product finds them up to rounding, a sum of squares gives the distance.
    """
    squares = np.einsum("ij,ij->i", held, held)
    step = max(1, NUMBERS_AT_ONCE // max(1, held.size))
    found = []
    for at in range(0, len(asked), step):
        some = asked[at : at + step]
        own = np.einsum("ij,ij->i", some, some)[:, None]
        rough = own + squares - 2 * some @ held.T
        limit = np.full((len(some), 1), np.inf)
        if len(held) > k:
            spare = 1e-9 * (own + squares.max())
            limit = np.partition(rough, k - 1, axis=1)[:, k - 1 : k] + spare
        query, document = np.nonzero(rough <= limit)
        gaps = some[query] - held[document]
        distance = np.einsum("ij,ij->i", gaps, gaps)
        order = np.lexsort((document, distance, query))
        query, document, distance = query[order], document[order], distance[order]
        best = np.arange(len(query)) - np.searchsorted(query, query) < k
        found.append((query[best] + at, document[best], distance[best]))
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def _meet(k: int, width: int, schema: T.StructType):
    """Task body: in each cell documents come first, then queries pass by."""
    from pyspark.sql.pandas.types import to_arrow_schema

    shape = to_arrow_schema(schema)

    def batch_of(hits: pd.DataFrame) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(hits[c], t.type) for c, t in zip(("query", "id", "distance"), shape, strict=True)],
            schema=shape,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, ids, vectors, held, waiting, count = None, [], [], None, [], 0
        for whole in batches:
            keys = np.stack([whole.column(c).to_numpy() for c in range(4)])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1), whole.num_rows]
            for start, end in zip(cuts, cuts[1:], strict=False):
                if start == end:
                    continue
                rows = whole.slice(start, end - start)
                now = tuple(keys[:3, start].tolist())
                if now != cell:
                    cell, ids, vectors, held = now, [], [], None
                here = as_matrix(rows.column("_vector"), width)
                if keys[3, start] == 0:
                    ids.append(rows.column("_document"))
                    vectors.append(here)
                    continue
                if not ids:
                    continue
                if held is None:
                    documents = pa.concat_arrays(ids)
                    order = pc.sort_indices(documents)
                    documents = documents.take(order)
                    held = np.concatenate(vectors)[order.to_numpy()]
                query, document, distance = _near_pairs(held, here, k)
                waiting.append(
                    pd.DataFrame(
                        {
                            "query": rows.column("_query").take(pa.array(query)).to_pandas(),
                            "id": documents.take(pa.array(document)).to_pandas(),
                            "distance": distance,
                        }
                    )
                )
                count += len(distance)
                if count > HITS_AT_ONCE:
                    waiting = [_fold(pd.concat(waiting), k)]
                    count = len(waiting[0])
                    if count > HITS_AT_ONCE // 2:
                        yield batch_of(waiting[0])
                        waiting, count = [], 0
        if waiting:
            yield batch_of(_fold(pd.concat(waiting), k))

    return run


def knn_approximate(
    documents: DataFrame,
    queries: DataFrame,
    k: int = DEFAULT_NEIGHBOURS,
    document_id: str = "id",
    query_id: str = "query_id",
    vector: str = "embedding",
    tables: HashTables | None = None,
) -> DataFrame:
    """The columns of ``knn_search``; nearly all of the nearest documents, exact distances.

    For distinct ids on both sides; rows without a vector have no neighbours
    and are none. No query is compared with all documents, and the sides of a
    hot bucket are split into cells. A query that finds fewer than ``k``
    documents is answered by the exact search.
    """
    schema = T.StructType(
        [
            T.StructField(query_id, queries.schema[query_id].dataType),
            T.StructField(document_id, documents.schema[document_id].dataType),
            T.StructField("distance", T.DoubleType()),
        ]
    )
    asked = materialise(queries.select(query_id, vector).where(F.col(vector).isNotNull()))
    usable = documents.select(document_id, vector).where(F.col(vector).isNotNull())
    tables = tables or fit_tables(usable, asked, k, document_id, query_id, vector)
    if tables is None:
        empty = documents.sparkSession.createDataFrame([], schema)
        return merge_hits(empty, k, document_id, query_id)
    cells = _cells(
        _bucketed(usable, document_id, vector, tables, False, False),
        _bucketed(asked, query_id, vector, tables, True, False),
    )
    held = _dealt(
        _bucketed(usable, document_id, vector, tables, False, True), cells, "_documents", "_queries", 0
    )
    passing = _dealt(
        _bucketed(asked, query_id, vector, tables, True, True), cells, "_queries", "_documents", 1
    )
    cell = ["_bucket", "_documents", "_queries"]
    met = (
        held.withColumn("_query", F.lit(None).cast(schema[0].dataType))
        .unionByName(passing.withColumn("_document", F.lit(None).cast(schema[1].dataType)))
        .select(*cell, "_kind", "_query", "_document", "_vector")
        .repartition(*cell)
        .sortWithinPartitions(*cell, "_kind")
    )
    hits = met.mapInArrow(_meet(k, tables.planes.shape[2], schema), schema)
    # A document met in several tables is one hit.
    once = hits.groupBy(query_id, document_id).agg(F.min("distance").alias("distance"))
    ranked = stage_table(merge_hits(once, k, document_id, query_id), "near")
    reached = ranked.groupBy(query_id).count().where(F.col("count") >= k)
    short = materialise(asked.join(reached, query_id, "left_anti"))
    if short.isEmpty():
        return ranked
    exact = knn_search(usable, short, k, document_id, query_id, vector)
    return ranked.join(short.select(query_id), query_id, "left_anti").unionByName(exact)


def recall_of(
    found: DataFrame, exact: DataFrame, document_id: str = "id", query_id: str = "query_id"
) -> DataFrame:
    """The share of the exact neighbours that were found, in one row; 1.0 if there are none."""
    keys = [query_id, document_id]
    hit = exact.select(*keys).join(found.select(*keys, F.lit(1).alias("_hit")), keys, "left")
    return hit.agg(F.coalesce(F.count("_hit") / F.count(F.lit(1)), F.lit(1.0)).alias("recall"))
