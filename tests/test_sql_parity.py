"""Every query with an SQL twin must equal it, value by value and type by type."""

import os

import pytest
from check_queries import difference, oracle

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return oracle(SF_DIR)


def test_every_twin_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    assert difference(entry.queries()[name](spark, SF_DIR), duck, entry.oracle_sql()[name]) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


# A third of the rows of each table share one key, source, day, score or label.
SKEWED = {
    "embeddings": "* replace (if(vec_id % 3 = 0, 0, vec_id)::bigint as vec_id,"
    " if(vec_id % 3 = 0, 1, label)::int as label)",
    "events": "* replace (if(event_id % 3 = 0, timestamp '2024-01-05 10:00:00', ts) as ts,"
    " if(event_id % 3 = 0, 'error', event_type) as event_type)",
    "documents": "* replace (if(doc_id % 3 = 0, 'one', source) as source,"
    " if(doc_id % 3 = 0, 100, n_chars)::bigint as n_chars)",
    "lineitem": "* replace (if(l_partkey % 3 = 0, 1, l_orderkey)::bigint as l_orderkey)",
    "labels": "*",
}


@pytest.fixture(scope="module")
def skewed(duck, tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duck.cursor()
    for table, columns in SKEWED.items():
        con.execute(f"copy (select {columns} from {table}) to '{folder}/{table}.parquet'")
    for table in SKEWED:
        con.execute(f"create or replace temp view {table} as from '{folder}/{table}.parquet'")
    return str(folder), con


@pytest.mark.parametrize(
    "name",
    [
        "read_matrix",
        "channel_quality",
        "channel_median_counted",
        "wafer_features",
        "wafer_features_wide",
        "ml_features",
        "daily_yield",
        "dq_report",
        "dq_unique",
        "roc_auc",
        "stratified_split",
        "catalog_corpus",
        "knn_search",
    ],
)
def test_query_equals_sql_on_skewed_tables(spark, skewed, name):
    folder, con = skewed
    assert difference(entry.queries()[name](spark, folder), con, entry.oracle_sql()[name]) is None
