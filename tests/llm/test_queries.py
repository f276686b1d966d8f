"""Registered text queries on the given tables, and the pipeline stage by stage."""

import pytest
from check_queries import difference, oracle

import __spark_entry__ as entry
import corpus_pipeline
from waferlens.llm import decontaminate, ngram_join, queries, secret_scan, substring

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return [(r["doc_id"], r["text"]) for r in queries.table(spark, SF_DIR, "documents").collect()]


def test_all_operators_are_registered():
    names = entry.queries()
    for number in range(1, 14):
        assert any(name.startswith(f"op{number}_") for name in names)
    assert names["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    found = queries.QUERIES[name](spark, SF_DIR)
    assert difference(found, oracle(SF_DIR), queries.ORACLE_SQL[name]) is None


def test_decontamination_query(spark, texts):
    items = [(r["item_id"], r["text"]) for r in queries.table(spark, SF_DIR, "benchmark").collect()]
    found = sorted(map(tuple, queries.op7_decontaminate(spark, SF_DIR).collect()))
    assert found == sorted(decontaminate.brute_force(texts, items))


def test_repeated_passages_query(spark, texts):
    found = sorted(map(tuple, queries.op9_repeated_passages(spark, SF_DIR).collect()))
    assert found == sorted(substring.brute_force(texts))


def test_stages_act_on_what_is_left(spark, tmp_path):
    docs = queries.table(spark, SF_DIR, "documents")
    columns, before = docs.columns, docs.count()
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        docs.write.parquet(str(tmp_path / name))
        docs = kept[name] = spark.read.parquet(str(tmp_path / name))
        if name != "best_fit_packing":
            assert docs.columns == columns
            assert 0 < docs.count() <= before
            before = docs.count()
    one = kept["ngram_jaccard_join"]
    assert ngram_join.near_duplicates(one).where("component_id <> doc_id").count() == 0
    items = queries.table(spark, SF_DIR, "benchmark")
    assert decontaminate.contamination(kept["benchmark_decontamination"], items).where("contaminated").count() == 0
    clean = kept["secret_scans"]
    assert clean.count() == kept["benchmark_decontamination"].count()
    assert secret_scan.scan(clean).where("n_assign + n_access + n_hex > 0").count() == 0
    assert clean.where("n_chars <> char_length(text)").count() == 0
    packed = kept["best_fit_packing"]
    assert packed.select("doc_id").distinct().count() == clean.count()


def test_pipeline_takes_odd_documents(spark, tmp_path):
    full = queries.table(spark, SF_DIR, "documents")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (10**6, None, None, None, None), (10**6 + 1, "", "en", "s", 0),
         (10**6 + 2, "long " * 100_000, None, None, 5)],
        full.schema,
    )
    docs = full.union(odd).union(full.limit(3)).selectExpr("*", "1 as n_shingles", "'x' as _keep")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == [*full.columns, "n_shingles", "_keep"]
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0
