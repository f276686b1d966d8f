"""Text files in, checked marts, model, metrics and search index out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession

from waferlens.config import PipelineConfig
from waferlens.operators import dq, evaluate, features, impute, quality, reshape, train, yields
from waferlens.operators import search as catalog_search
from waferlens.plans.checks import PIPELINE_CHECKS
from waferlens.shared import stage_table, staging
from waferlens.sources import documents, labels, matrix, tables, versions
from waferlens.sources.tables import BRONZE, INTERMEDIATE, MARTS, STAGING, write_table

ENCODER_NAME = "hashed-tfidf"
# Tables that are published together, in the schema of the marts.
MART_COLLECTION, MART_NAMES = "marts", ("daily_yield", "yield_summary", "ml_features")
INDEX_COLLECTION, INDEX_NAMES = "catalog", ("catalog_index", "catalog_manifest")
DESCRIPTIONS = {
    "sensor_readings_wide": "Raw readings as they came, one row for each wafer, all channels in one array.",
    "sensor_readings_long": "Raw readings, one row for each wafer and channel.",
    "labels_raw": "Raw pass/fail log lines, one for each wafer, with the time still a text.",
    "readings": "Readings with the sentinel and NaN turned into NULL, and a flag for the sentinel.",
    "labels": "Test results with a readable status, a binary target and the time parsed.",
    "sensor_quality": "Profile of every channel: counts, share of gaps, spread, and its rank by spread.",
    "wafer_features": "The selected channels of every wafer as columns, gaps filled with channel medians.",
    "ml_features": "The ML training table: wafer features and labels.",
    "daily_yield": "Yield of each test day: wafers tested, passed and failed, and their rates.",
    "yield_summary": "Yield over all tested wafers in a single row.",
    "catalog_index": "Search index: documents about the published tables with their vectors.",
    "catalog_manifest": "What the search index holds and which encoder made it.",
}
COLUMN_COMMENTS = {
    "labels": {
        "wafer_id": "Position of the wafer in its source file.",
        "yield_status": "pass or fail as a word, unknown for any other label.",
        "is_fail": "1 where the wafer failed, 0 where it passed, NULL where unknown.",
        "tested_at": "Time of the test, NULL where the text is no time.",
    },
    "sensor_quality": {
        "sensor_id": "Number of the channel, from 1.",
        "null_pct": "Share of missing readings, in percent.",
        "reading_stddev": "Sample standard deviation of the readings there are.",
        "sensor_rank": "Place of the channel, widest spread first, gappy channels last.",
        "is_selected_for_ml": "Whether the channel becomes a feature.",
    },
    "wafer_features": {
        "wafer_id": "Position of the wafer in its source file.",
        "any_imputed_flag": "1 if any feature of the wafer was filled.",
        "imputed_sensor_count": "How many features of the wafer were filled.",
    },
    "ml_features": {
        "wafer_id": "Key of the table: position of the wafer in its source file.",
        "is_fail": "Training target, 1 where the wafer failed its test and 0 where it passed.",
        "test_date": "Calendar day of the test.",
        "imputed_sensor_count": "How many features of this wafer were filled with a median.",
        "feature_001": "Reading of the channel with the widest spread, gaps filled.",
        "feature_set_built_at": "When this table was last rebuilt.",
    },
    "daily_yield": {
        "test_date": "Calendar day the KPIs belong to.",
        "yield_rate_pct": "Share of the day's wafers that passed, in percent.",
    },
    "yield_summary": {
        "total_wafers": "Number of labelled wafers.",
        "overall_yield_rate_pct": "Share of all wafers that passed, in percent.",
    },
}


@dataclass(frozen=True)
class BronzeTables:
    wide: DataFrame
    long: DataFrame
    labels: DataFrame


@dataclass(frozen=True)
class SilverTables:
    readings: DataFrame
    labels: DataFrame
    quality: DataFrame
    features: DataFrame


@dataclass(frozen=True)
class TrainingRun:
    model: RandomForestClassificationModel
    scored: DataFrame
    metrics: DataFrame
    fills: dict[str, float]
    features: list[str]


@dataclass(frozen=True)
class Scorer:
    """A stored model with all that scoring takes."""

    model: RandomForestClassificationModel
    features: list[str]
    fills: dict[str, float]

    def score(self, mart: DataFrame) -> DataFrame:
        return train.score_batch(self.model, mart, self.features, self.fills)


def _write(df: DataFrame, layer: str, name: str, root: str | None) -> DataFrame:
    """Write a table with its description."""
    return write_table(df, layer, name, root, COLUMN_COMMENTS.get(name), DESCRIPTIONS[name])


def _add(df: DataFrame, layer: str, name: str, version: str, root: str | None) -> DataFrame:
    """Write a version of a table with its description; readers see it when it is published."""
    return versions.add(df, layer, name, version, root, COLUMN_COMMENTS.get(name), DESCRIPTIONS[name])


def _publish(
    spark: SparkSession, layer: str, collection: str, version: str, built: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    """Make the written tables those that readers see, all at once, and remove old ones."""
    versions.switch(spark, layer, collection, version, {n: df.columns for n, df in built.items()})
    versions.clean_up(spark, layer, collection, list(built))
    return {name: spark.table(f"{layer}.{name}") for name in built}


def load_bronze(
    spark: SparkSession,
    matrix_path: str,
    labels_path: str,
    root: str | None = None,
    prefix: str = "",
) -> BronzeTables:
    """Read both files and replace the three raw tables.

    ``prefix`` stands before the names of all schemas of a run.
    """
    tables.require_inputs(spark, matrix_path, labels_path)
    layer = prefix + BRONZE
    wide = _write(matrix.read_matrix(spark, matrix_path), layer, "sensor_readings_wide", root)
    return BronzeTables(
        wide,
        _write(reshape.melt_array(wide), layer, "sensor_readings_long", root),
        _write(labels.read_labels(spark, labels_path), layer, "labels_raw", root),
    )


def readings_view(config: PipelineConfig, prefix: str = "") -> str:
    """``quality.stage_readings`` of the raw readings, as the SQL of a view."""
    sentinel = f"{config.sentinel!r}D"
    return f"""
        SELECT wafer_id, sensor_id,
            CASE WHEN NOT isnan(reading_value) AND reading_value <> {sentinel}
                THEN reading_value END AS reading_value,
            coalesce(reading_value = {sentinel}, false) AS is_imputed_source_missing
        FROM {prefix}{BRONZE}.sensor_readings_long"""


def build_silver(
    bronze: BronzeTables,
    config: PipelineConfig = PipelineConfig(),
    root: str | None = None,
    prefix: str = "",
) -> SilverTables:
    """Cleaned readings and labels, the ranked channels, one feature row per wafer.

    Cleaning readings is a cheap projection, so that stays a view over bronze.
    Labels are parsed once into a table, whose times and dates then filter at
    the scan. The ranked channels are a table too, as everything after joins
    it. Features come from the wide table, where a wafer is one row already and
    nothing is shuffled.
    """
    spark, layer = bronze.long.sparkSession, prefix + INTERMEDIATE
    readings = tables.write_view(
        spark, prefix + STAGING, "readings", readings_view(config, prefix), DESCRIPTIONS["readings"], root
    )
    staged_labels = _write(yields.stage_labels(bronze.labels, config), prefix + STAGING, "labels", root)
    ranked = _write(quality.channel_quality(readings, config), layer, "sensor_quality", root)
    fills = impute.fill_channels(ranked, readings)
    wide = features.wafer_features_wide(bronze.wide, fills, config)
    return SilverTables(readings, staged_labels, ranked, _write(wide, layer, "wafer_features", root))


def build_gold(
    silver: SilverTables,
    config: PipelineConfig = PipelineConfig(),
    built_at: Column | None = None,
    root: str | None = None,
    prefix: str = "",
) -> dict[str, DataFrame]:
    """Build the marts unseen, check everything, and only then publish them by one switch."""
    spark, layer = silver.labels.sparkSession, prefix + MARTS
    version = versions.begin(spark, layer, MART_COLLECTION, MART_NAMES, root)
    marts = {
        "daily_yield": yields.daily_yield(silver.labels, config, stored=True),
        "yield_summary": yields.yield_summary(silver.labels, config),
        "ml_features": features.ml_features(silver.features, silver.labels, config, built_at=built_at),
    }
    built = {name: _add(df, layer, name, version, root) for name, df in marts.items()}
    report = dq.run_suite(
        {
            "staged_readings": silver.readings,
            "staged_labels": silver.labels,
            "sensor_quality": silver.quality,
            "wafer_features": silver.features,
            **built,
        },
        PIPELINE_CHECKS,
    )
    try:
        dq.require_clean(report)
    except dq.DataQualityError:
        versions.clean_up(spark, layer, MART_COLLECTION, MART_NAMES)
        raise
    return _publish(spark, layer, MART_COLLECTION, version, built)


def train_and_evaluate(
    mart: DataFrame, trees: int = train.TREES, depth: int = train.DEPTH, seed: int = train.SEED
) -> TrainingRun:
    """Split, fit on the training rows, score the test rows, record the metrics."""
    names = train.feature_columns(mart)
    split = train.stratified_split(train.with_target(mart), seed=seed)
    learned = split.where("split = 'train'")
    fills = train.fill_values(learned, names)
    model = train.train_forest(learned, names, trees=trees, depth=depth, seed=seed, fills=fills)
    # Scoring walks every tree, so it is done once for all metrics.
    scored = stage_table(
        train.score_batch(model, split.where("split = 'test'"), names, fills), "scored"
    )
    top = train.top_features(mart.sparkSession, model, names)
    return TrainingRun(model, scored, evaluate.metrics_record(split, scored, names, top), fills, names)


def build_index(
    spark: SparkSession,
    table_names: list[str],
    glossary_path: str,
    root: str | None = None,
    prefix: str = "",
) -> tuple[DataFrame, catalog_search.TextEncoder]:
    """Replace the search index: documents with vectors, and the encoder for queries.

    Index and manifest are published by one switch; searches that run go on
    with the index they began with.
    """
    corpus = documents.catalog_corpus(
        documents.catalog_docs(documents.tables_catalog(spark, table_names)),
        documents.read_chunks(spark, glossary_path),
    )
    return publish_index(corpus, root, prefix)


def publish_index(
    corpus: DataFrame, root: str | None = None, prefix: str = ""
) -> tuple[DataFrame, catalog_search.TextEncoder]:
    """Index any documents (id, text, metadata) in place of those indexed before."""
    if corpus.isEmpty():
        raise RuntimeError("no documents to index")
    spark, layer = corpus.sparkSession, prefix + MARTS
    version = versions.begin(spark, layer, INDEX_COLLECTION, INDEX_NAMES, root)
    with staging(spark):
        embedded, encoder = catalog_search.fit_and_embed(corpus)
        index = _add(embedded, layer, "catalog_index", version, root)
    manifest = documents.index_manifest(index, "catalog_index", ENCODER_NAME)
    built = {"catalog_index": index, "catalog_manifest": _add(manifest, layer, "catalog_manifest", version, root)}
    return _publish(spark, layer, INDEX_COLLECTION, version, built)["catalog_index"], encoder


def save_run(run: TrainingRun, folder: str) -> None:
    """The metrics as JSON and the model with its inputs, replacing those of an earlier run."""
    tables.write_json(run.metrics, f"{folder}/metrics")
    train.save_model(run.model, f"{folder}/model")
    train.save_inputs(run.scored.sparkSession, f"{folder}/inputs", run.features, run.fills)


def load_scorer(spark: SparkSession, folder: str) -> Scorer:
    """The model of a saved run, ready to score any table with its features."""
    features, fills = train.load_inputs(spark, f"{folder}/inputs")
    return Scorer(train.load_model(f"{folder}/model"), features, fills)


def run_pipeline(
    spark: SparkSession,
    matrix_path: str,
    labels_path: str,
    config: PipelineConfig = PipelineConfig(),
    built_at: Column | None = None,
    root: str | None = None,
    prefix: str = "",
) -> dict[str, DataFrame]:
    """Files to published marts; what the run staged on the way is removed."""
    with staging(spark):
        bronze = load_bronze(spark, matrix_path, labels_path, root, prefix)
        silver = build_silver(bronze, config, root, prefix)
        return build_gold(silver, config, built_at, root, prefix)
