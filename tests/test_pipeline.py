"""Text files to marts, model, metrics and search index."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from waferlens.config import PipelineConfig
from waferlens.operators import dq, search, train
from waferlens.plans import pipeline
from waferlens.sources import tables

CONFIG = PipelineConfig(top_sensors=6)


def make_files(folder, wafers=120, channels=12, bad_label=False, seed=1):
    rng = random.Random(seed)
    lines, log = [], []
    start = dt.datetime(2020, 1, 1)
    for w in range(wafers):
        fail = rng.random() < 0.5
        cells = [rng.gauss(5 * fail, c + 1) for c in range(channels)]
        lines.append(" ".join("NaN" if rng.random() < 0.1 else "-200" if rng.random() < 0.1 else repr(x) for x in cells))
        label = 3 if bad_label and w == 7 else -1 if fail else 1
        log.append(f'{label} "{(start + dt.timedelta(hours=w)).strftime("%d/%m/%Y %H:%M:%S")}"')
    (folder / "readings.data").write_text("\n".join(lines) + "\n")
    (folder / "labels.data").write_text("\r\n".join(log) + "\r\n")
    return str(folder / "readings.data"), str(folder / "labels.data")


@pytest.fixture(scope="module")
def marts(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("files")
    paths = make_files(folder)
    built_at = F.lit(dt.datetime(2024, 1, 1))
    return pipeline.run_pipeline(spark, *paths, CONFIG, built_at)


def test_marts_are_published(spark, marts):
    assert set(marts) == {"daily_yield", "yield_summary", "ml_features"}
    summary = spark.table("marts.yield_summary").first()
    assert summary["total_wafers"] == 120
    assert summary["total_fails"] + summary["total_passes"] == 120
    assert spark.table("marts.daily_yield").agg(F.sum("wafer_count")).first()[0] == 120
    mart = tables.read_table(spark, "marts.ml_features", "wafer_id")
    assert [r["wafer_id"] for r in mart.select("wafer_id").collect()] == list(range(1, 121))
    assert train.feature_columns(mart) == CONFIG.feature_names
    assert mart.where("feature_001 is null").isEmpty()
    audit = tables.ingest_audit(
        spark.table("bronze.sensor_readings_wide"), spark.table("bronze.sensor_readings_long")
    ).first()
    assert tuple(audit) == (120, 1440, 12)


def test_rerun_replaces_everything(spark, marts, tmp_path):
    paths = make_files(tmp_path, wafers=30)
    pipeline.load_bronze(spark, *paths, root=str(tmp_path / "lake"))
    pipeline.load_bronze(spark, *paths, root=str(tmp_path / "lake"))
    assert spark.table("bronze.labels_raw").count() == 30


def test_unclean_labels_are_never_published(spark, marts, tmp_path):
    paths = make_files(tmp_path, wafers=40, bad_label=True)
    with pytest.raises(dq.DataQualityError, match="is_fail"):
        pipeline.run_pipeline(spark, *paths, CONFIG)
    assert spark.table("marts.yield_summary").first()["total_wafers"] == 120


def test_missing_input_stops_before_any_write(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="nowhere.data"):
        pipeline.load_bronze(spark, str(tmp_path / "nowhere.data"), str(tmp_path / "x"))


def test_reading_absent_or_empty_marts_fails(spark, marts):
    with pytest.raises(RuntimeError, match="does not exist"):
        tables.read_table(spark, "marts.nothing")
    tables.write_table(spark.range(0).toDF("wafer_id"), "marts", "nothing_yet")
    with pytest.raises(RuntimeError, match="is empty"):
        tables.read_table(spark, "marts.nothing_yet")


def test_training_scores_and_records(spark, marts, tmp_path):
    mart = tables.read_table(spark, "marts.ml_features")
    run = pipeline.train_and_evaluate(mart, trees=20, depth=4)
    record = run.metrics.first()
    assert (record["rows_total"], record["rows_train"], record["rows_test"]) == (120, 96, 24)
    assert record["feature_count"] == 6
    assert sum(map(sum, record["confusion_matrix"])) == 24
    assert 0.5 < record["roc_auc"] <= 1.0
    assert len(record["top_features"]) == 6
    pipeline.save_run(run, str(tmp_path))
    pipeline.save_run(run, str(tmp_path))
    assert spark.read.json(str(tmp_path / "metrics")).first()["rows_test"] == 24
    again = train.score_batch(
        train.load_model(str(tmp_path / "model")),
        run.scored.drop("prediction", "score"),
        CONFIG.feature_names,
        run.fills,
    )
    assert again.select("wafer_id", "score").exceptAll(run.scored.select("wafer_id", "score")).isEmpty()
    scorer = pipeline.load_scorer(spark, str(tmp_path))
    assert (scorer.features, scorer.fills) == (CONFIG.feature_names, run.fills)
    gap = run.scored.drop("prediction", "score").withColumn("feature_002", F.lit(None).cast("double"))
    with pytest.raises(Exception, match="feature_002|null|NULL"):
        scorer.score(gap).collect()


def test_index_answers_questions_about_the_tables(spark, marts, tmp_path):
    glossary = tmp_path / "glossary.md"
    glossary.write_text("# Terms\n\n## Yield\nShare of wafers that passed.\n\n## Lot\nWafers made together.\n")
    names = [f"marts.{name}" for name in marts]
    index, encoder = pipeline.build_index(spark, names, str(glossary))
    kinds = {r[0]: r[1] for r in index.groupBy(F.element_at("metadata", "type")).count().collect()}
    assert kinds["model"] == 3 and kinds["glossary"] == 3
    manifest = spark.table("marts.catalog_manifest").first()
    assert manifest["document_count"] == index.count()
    questions = spark.createDataFrame([(0, "wafers made together")], "query_id int, text string")
    hits = search.search(index, questions, encoder, k=3)
    best = hits.orderBy("rank").first()
    assert best["id"] == "glossary::2"
    assert best["headline"].startswith("[glossary] Lot")
    asked = spark.createDataFrame([(1, "what is the ML training table")], "query_id int, text string")
    assert search.search(index, asked, encoder).orderBy("rank").first()["id"] == "model::marts.ml_features"
    assert index.where("text like '%: '").where("metadata['type'] = 'model'").isEmpty()
    with pytest.raises(RuntimeError, match="no documents"):
        search.search(index.limit(0), questions, encoder)


def test_staged_readings_are_a_view_and_candidates_are_gone(spark, marts):
    from waferlens.operators import quality

    kind = {t.name: t.tableType for t in spark.catalog.listTables("staging")}
    assert kind["readings"] == "VIEW"
    view = spark.table("staging.readings")
    built = quality.stage_readings(spark.table("bronze.sensor_readings_long"), CONFIG)
    assert view.schema == built.schema and view.exceptAll(built).isEmpty() and built.exceptAll(view).isEmpty()
    assert {t.name for t in spark.catalog.listTables("marts")} >= {"ml_features", "daily_yield"}
    assert not [t.name for t in spark.catalog.listTables("marts") if "__" in t.name]


def test_queries_leave_tables_of_the_session_alone(spark, marts):
    from waferlens.plans import queries

    before = {n: spark.table(n).count() for n in ("marts.ml_features", "bronze.labels_raw")}
    for name in ("mart_read", "bronze_write"):
        queries.QUERIES[name](spark, "/root/testdata/sf0.001").collect()
    assert {n: spark.table(n).count() for n in before} == before


def test_staged_tables_are_removed_after_a_run(spark, tmp_path):
    from pathlib import Path

    from waferlens.shared import shared_dir, stage_table, staging

    with staging(spark):
        stage_table(spark.range(3), "to-go")
        folder = Path(shared_dir(spark).removeprefix("file:")) / "tables"
        assert [p for p in folder.iterdir() if p.name.startswith("to-go")]
    assert not [p for p in folder.iterdir() if p.name.startswith("to-go")]
