"""Approximate neighbours against the exact search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from waferlens.operators import neighbours, search


def frame(spark, vectors, key):
    rows = [(f"k{i:05d}", [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, f"{key} string, embedding array<double>").repartition(4)


def clustered(count, width=24, centres=12, seed=1):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, 1, (centres, width))
    return middle[rng.integers(0, centres, count)] + rng.normal(0, 0.3, (count, width))


def recall(spark, vectors, asked, k=10, **options):
    documents, queries = frame(spark, vectors, "id"), frame(spark, asked, "query_id")
    tables = neighbours.fit_tables(documents, queries, k, **options)
    found = neighbours.knn_approximate(documents, queries, k, tables=tables)
    exact = search.knn_search(documents, queries, k)
    assert found.groupBy("query_id").count().where(f"count <> {k}").isEmpty()
    return neighbours.recall_of(found, exact).first()["recall"], tables


def test_nearly_all_neighbours_of_clusters_are_found_in_few_buckets(spark):
    vectors = clustered(4_200)
    share, tables = recall(spark, vectors[:4_000], vectors[4_000:], bucket_rows=32)
    assert share >= 0.9
    assert tables.buckets == 128 and tables.probes < 32


def test_nearly_all_neighbours_of_uniform_vectors_are_found(spark):
    rng = np.random.default_rng(5)
    share, tables = recall(spark, rng.normal(0, 1, (3_000, 16)), rng.normal(0, 1, (100, 16)), bucket_rows=64)
    assert share >= 0.9 and tables.probes < tables.buckets


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the documents are one vector, and half of the queries another."""
    vectors = clustered(900, width=8)
    vectors[:300] = vectors[0]
    asked = clustered(80, width=8, seed=3)
    asked[:40] = vectors[0] + 0.01
    return frame(spark, vectors, "id"), frame(spark, asked, "query_id")


def test_hot_buckets_are_split_and_give_the_same(spark, hot, monkeypatch):
    documents, queries = hot
    tables = neighbours.fit_tables(documents, queries, 5, bucket_rows=32)
    whole = neighbours.knn_approximate(documents, queries, 5, tables=tables).collect()
    monkeypatch.setattr(neighbours, "ROWS_PER_CELL", 50)
    monkeypatch.setattr(neighbours, "QUERIES_PER_CELL", 7)
    cells = neighbours._cells(
        neighbours._bucketed(documents, "id", "embedding", tables, False, False),
        neighbours._bucketed(queries, "query_id", "embedding", tables, True, False),
    )
    assert cells.agg(F.max("_documents"), F.max("_queries")).first()[0] >= 6
    monkeypatch.setattr(neighbours, "HITS_AT_ONCE", 20)
    monkeypatch.setattr(neighbours, "NUMBERS_AT_ONCE", 100)
    split = neighbours.knn_approximate(documents, queries, 5, tables=tables).collect()
    assert sorted(whole) == sorted(split)
    # Equally near documents come in the order of their ids, as in the exact search.
    tied = [r for r in whole if r["query_id"] == "k00000"]
    assert [r["id"] for r in sorted(tied, key=lambda r: r["rank"])] == [f"k{i:05d}" for i in range(5)]


def test_no_pairs_of_all_queries_and_documents(hot):
    documents, queries = hot
    tables = neighbours.fit_tables(documents, queries, 5, bucket_rows=8)
    met = neighbours._bucketed(documents, "id", "embedding", tables, False, False).join(
        neighbours._bucketed(queries, "query_id", "embedding", tables, True, False), "_bucket"
    )
    plan = neighbours.knn_approximate(documents, queries, 5, tables=tables)
    text = plan._jdf.queryExecution().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert met.count() < len(tables.planes) * documents.count() * queries.count()


def test_queries_with_few_documents_nearby_are_answered_exactly(spark):
    far = np.concatenate([clustered(200, width=6) + 50, clustered(3, width=6) - 50])
    documents, queries = frame(spark, far, "id"), frame(spark, far[-3:], "query_id")
    tables = neighbours.fit_tables(documents, queries, 20, bucket_rows=16)
    tables = neighbours.HashTables(tables.planes, tables.centre, 1)
    found = neighbours.knn_approximate(documents, queries, 20, tables=tables)
    assert found.exceptAll(search.knn_search(documents, queries, 20)).isEmpty()
    assert found.count() == 60


def test_empty_and_missing_vectors(spark):
    documents, queries = frame(spark, clustered(50), "id"), frame(spark, clustered(5), "query_id")
    gap = spark.createDataFrame([("none", None)], documents.schema)
    found = neighbours.knn_approximate(documents.union(gap), queries.union(gap.toDF("query_id", "embedding")))
    assert found.where("id = 'none' or query_id = 'none'").isEmpty() and found.count() == 25
    assert neighbours.knn_approximate(documents.limit(0), queries).isEmpty()
    assert neighbours.knn_approximate(documents, queries.limit(0)).isEmpty()
    fewer = neighbours.knn_approximate(documents.limit(3), queries)
    assert fewer.count() == 15
