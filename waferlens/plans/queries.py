"""Every operator bound to the given tables, for checking and timing.

The tables hold no wafers, so sensor readings are derived from ``embeddings``
(a vector is a wafer, an element a channel reading), test labels from
``events`` and classifier output from ``labels`` and ``documents``. Every
query runs over its whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waferlens.config import PipelineConfig
from waferlens.operators import (
    dq,
    evaluate,
    features,
    impute,
    neighbours,
    quality,
    reshape,
    search,
    sketches,
    train,
    yields,
)
from waferlens.plans import pipeline
from waferlens.plans.checks import PIPELINE_CHECKS
from waferlens.plans.pipeline import ENCODER_NAME
from waferlens.shared import scratch_path, stage_table
from waferlens.sources import documents, labels, matrix, ordinals, tables, versions
from waferlens.streaming import labels as label_streams
from waferlens.streaming import yields as yield_streams

Query = Callable[[SparkSession, str], DataFrame]

# About 9.1 % of the derived readings are missing, so this limit parts the channels.
CONFIG = PipelineConfig(max_null_fraction=0.09)
LINE = "\n"
BUILT_AT = "2024-01-02 03:04:05"
NEIGHBOURS = 10
COLLECTION, ENCODER = "catalog", ENCODER_NAME
QUESTIONS = [
    "which documents describe the training table",
    "la question et la ouelle",
    "what is the license",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(*names: str, digits: int = 6) -> dict[str, Column]:
    return {name: F.round(name, digits) for name in names}


# --- derived inputs ---------------------------------------------------------------


def _reading(wafer: Column, position: Column, element: Column) -> Column:
    missing = (wafer * 7 + position + 1) % 11 == 0
    return F.when(missing, F.lit(CONFIG.sentinel)).otherwise(element.cast("double"))


def raw_matrix(spark, sf_dir) -> DataFrame:
    """One array of raw readings per wafer."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("wafer_id"),
        F.transform("embedding", lambda x, i: _reading(F.col("vec_id"), i, x)).alias("values"),
    )


def raw_readings(spark, sf_dir) -> DataFrame:
    """One row per wafer and channel."""
    long = reshape.melt_array(
        table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "sensor_id", "element"
    )
    return long.select(
        F.col("vec_id").alias("wafer_id"),
        "sensor_id",
        _reading(F.col("vec_id"), F.col("sensor_id") - 1, F.col("element")).alias("reading_value"),
    )


def raw_labels(spark, sf_dir) -> DataFrame:
    """One raw label per wafer, its time as a text with unpadded day and month."""
    day = F.concat_ws("/", F.dayofmonth("ts"), F.month("ts"), F.year("ts"))
    clock = F.substring(F.col("ts").cast("string"), 12, 8)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("wafer_id"),
        F.when(F.col("event_type") == "error", -1)
        .when(F.col("event_type") == "signup", 0)
        .otherwise(1)
        .alias("pass_fail_raw"),
        F.when(F.col("event_id") % 97 == 0, "bad")
        .otherwise(F.concat_ws(" ", day, clock))
        .alias("timestamp_str"),
    )


def staged_readings(spark, sf_dir) -> DataFrame:
    return quality.stage_readings(raw_readings(spark, sf_dir), CONFIG)


def staged_labels(spark, sf_dir) -> DataFrame:
    return yields.stage_labels(raw_labels(spark, sf_dir), CONFIG)


def matrix_file(spark, sf_dir) -> str:
    """The raw matrix as text files, lines in wafer order."""
    path = scratch_path(spark, "matrix")
    line = F.concat_ws(" ", F.col("values").cast("array<string>"))
    rows = raw_matrix(spark, sf_dir).orderBy("wafer_id", "values")
    rows.select(line.alias("value")).write.text(path)
    return path


def label_file(spark, sf_dir) -> str:
    """The raw labels as a text log in wafer order: quoted, but bare for unknown labels."""
    path = scratch_path(spark, "labels")
    quote = F.when(F.col("pass_fail_raw") == 0, "").otherwise('"')
    line = F.concat(
        F.col("pass_fail_raw").cast("string"), F.lit(" "), quote, F.col("timestamp_str"), quote
    )
    raw_labels(spark, sf_dir).orderBy("wafer_id").select(line.alias("value")).write.text(path)
    return path


def evaluation(spark, sf_dir) -> DataFrame:
    """Truth, prediction and score per labelled document."""
    return (
        table(spark, sf_dir, "labels")
        .join(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
        .select(
            F.col("quality").alias("truth"),
            F.col("toxic").alias("prediction"),
            F.col("n_chars").alias("score"),
        )
    )


def feature_parts(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(staged readings, selected channels with medians)."""
    staged = staged_readings(spark, sf_dir)
    ranked = quality.channel_quality(staged, CONFIG)
    return staged, impute.fill_channels(ranked, staged)


# --- sources ------------------------------------------------------------------------


def read_matrix(spark, sf_dir) -> DataFrame:
    return matrix.widen(matrix.read_matrix(spark, matrix_file(spark, sf_dir)))


def row_ordinal(spark, sf_dir) -> DataFrame:
    return ordinals.number_rows(
        ordinals.read_lines(spark, label_file(spark, sf_dir)), "row_number"
    )


def parse_labels(spark, sf_dir) -> DataFrame:
    return labels.read_labels(spark, label_file(spark, sf_dir))


def own_schemas() -> str:
    """A prefix for schemas of this call alone, so that no table of the session is touched."""
    return f"query_{uuid.uuid4().hex[:12]}_"


def bronze_write(spark, sf_dir) -> DataFrame:
    root, layer = scratch_path(spark, "bronze"), own_schemas() + tables.BRONZE
    raw = raw_matrix(spark, sf_dir)
    wide = tables.write_table(raw, layer, "sensor_readings_wide", root)
    long = tables.write_table(reshape.melt_array(wide), layer, "sensor_readings_long", root)
    logged = tables.write_table(raw_labels(spark, sf_dir), layer, "labels_raw", root)
    return evaluate.one_row(
        tables.ingest_audit(wide, long), logged.agg(F.count(F.lit(1)).alias("label_count"))
    )


def ingest_audit(spark, sf_dir) -> DataFrame:
    return tables.ingest_audit(raw_matrix(spark, sf_dir), raw_readings(spark, sf_dir))


def distinct_users(spark, sf_dir) -> DataFrame:
    """Users of each day, and of all days, from sketches stored day by day in three loads.

    Next to the exact counts: whether the estimate is within its bound, and
    whether merging gives what one pass over all events gives.
    """
    events = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("date").alias("day"))
    path, odd = scratch_path(spark, "user-sketches"), F.dayofmonth("day") % 2 == 1
    for load in (events.where(odd), events.where(~odd), events.where(F.dayofmonth("day") < 5)):
        sketches.store_sketches(sketches.distinct_sketches(load, "user_id", ["day"]), path, "day")
    stored = spark.read.parquet(path).select(F.col("day").cast("date"), sketches.SKETCH)
    total = sketches.merge_sketches(stored).withColumn("day", F.lit(None).cast("date"))
    one_pass = sketches.distinct_sketches(events, "user_id").unionByName(
        sketches.distinct_sketches(events, "user_id", ["day"]), allowMissingColumns=True
    )
    # A row for each day, whatever the events.
    estimates = (
        stored.unionByName(total)
        .select("day", sketches.distinct_estimate().alias("_estimate"))
        .join(
            one_pass.select(F.col("day").alias("_day"), sketches.distinct_estimate().alias("_once")),
            F.col("day").eqNullSafe(F.col("_day")),
        )
    )
    exact = events.rollup("day").agg(F.countDistinct("user_id").alias("users"))
    apart = F.abs(F.col("_estimate") - F.col("users"))
    return exact.withColumnRenamed("day", "_of").join(
        estimates, F.col("_of").eqNullSafe(F.col("day"))
    ).select(
        "day",
        "users",
        (apart <= sketches.error_bound() * F.col("users")).alias("within_bound"),
        (F.col("_estimate") == F.col("_once")).alias("merged_equals_one_pass"),
    )


def melt_long(spark, sf_dir) -> DataFrame:
    return reshape.melt_columns(matrix.widen(raw_matrix(spark, sf_dir)))


def mart_read(spark, sf_dir) -> DataFrame:
    layer = own_schemas() + tables.MARTS
    tables.write_table(ml_features(spark, sf_dir), layer, "ml_features", scratch_path(spark, "marts"))
    return tables.read_table(spark, f"{layer}.ml_features", "wafer_id")


def clean_label_file(spark, sf_dir) -> str:
    """All labels as a log that passes every check: events but errors passed, times as they are."""
    path = scratch_path(spark, "labels")
    day = F.concat_ws("/", F.dayofmonth("ts"), F.month("ts"), F.year("ts"))
    clock = F.substring(F.col("ts").cast("string"), 12, 8)
    label = F.when(F.col("event_type") == "error", "-1").otherwise("1")
    line = F.concat(label, F.lit(' "'), day, F.lit(" "), clock, F.lit('"'))
    events = table(spark, sf_dir, "events")
    events.orderBy("event_id").select(line.alias("value")).write.text(path)
    return path


def published_marts(spark, sf_dir) -> DataFrame:
    """Two text files through the whole pipeline; of its marts the daily yield and the row counts."""
    marts = pipeline.run_pipeline(
        spark,
        matrix_file(spark, sf_dir),
        clean_label_file(spark, sf_dir),
        CONFIG,
        prefix=own_schemas(),
    )
    rows = marts["ml_features"].agg(
        F.count(F.lit(1)).alias("feature_rows"), F.sum("is_fail").alias("feature_fails")
    )
    total = marts["yield_summary"].select("total_wafers")
    # One row, which bounds the broadcast.
    return marts["daily_yield"].join(F.broadcast(evaluate.one_row(rows, total)))


def _documents_by_lang(spark, sf_dir, langs: Column) -> DataFrame:
    """Documents to index: text, and the language as metadata."""
    docs = table(spark, sf_dir, "documents").where(langs)
    return docs.select(
        F.format_string("doc::%d", "doc_id").alias("id"),
        "text",
        F.create_map(F.lit("lang"), F.col("lang")).alias("metadata"),
    )


def index_rebuild(spark, sf_dir) -> DataFrame:
    """A search index made twice, of English documents and then of all.

    What readers see after each switch, what both published versions hold on
    disk, and the documents of the second by language.
    """
    prefix, root = own_schemas(), scratch_path(spark, "index")
    layer = prefix + tables.MARTS
    seen = []
    for langs in (F.col("lang") == "en", F.lit(True)):
        pipeline.publish_index(_documents_by_lang(spark, sf_dir, langs), root, prefix)
        seen.append(spark.table(f"{layer}.catalog_manifest").first()["document_count"])
    index = spark.table(f"{layer}.catalog_index")
    kept = spark.table(versions.stored_name(layer, "catalog_index"))
    by_lang = index.groupBy(F.element_at("metadata", "lang").alias("lang")).agg(
        F.count(F.lit(1)).alias("documents")
    )
    # One row, which bounds the broadcast.
    sizes = kept.agg(F.count(F.lit(1)).alias("stored"), F.count_distinct(versions.VERSION).alias("versions"))
    return by_lang.select(
        "lang",
        "documents",
        *(F.lit(n).cast("long").alias(c) for c, n in zip(("first_seen", "last_seen"), seen, strict=True)),
    ).join(F.broadcast(sizes))


def _marts_seen(spark, layer: str) -> tuple:
    """What readers find in the published marts."""
    total = spark.table(f"{layer}.yield_summary").first()
    days = spark.table(f"{layer}.daily_yield").agg(F.sum("fail_count")).first()
    rows = spark.table(f"{layer}.ml_features").agg(F.sum(F.xxhash64("wafer_id", "is_fail") % 1_000)).first()
    version = versions.current_version(spark, layer, pipeline.MART_COLLECTION)
    return (*total, *days, *rows, version)


def guard_report(spark, sf_dir) -> DataFrame:
    """What each guard did after a clean run: on a missing file, an absent, an empty and a failing table."""
    prefix = own_schemas()
    layer = prefix + tables.MARTS
    readings, clean = matrix_file(spark, sf_dir), clean_label_file(spark, sf_dir)
    pipeline.run_pipeline(spark, readings, clean, CONFIG, prefix=prefix)
    published = _marts_seen(spark, layer)
    tables.write_table(spark.table(f"{layer}.yield_summary").limit(0), layer, "nothing_yet")
    unclean = label_file(spark, sf_dir)
    attempts = {
        "missing_file": lambda: pipeline.run_pipeline(spark, readings, clean + "-none", CONFIG, prefix=prefix),
        "absent_table": lambda: tables.read_table(spark, f"{layer}.nothing"),
        "empty_table": lambda: tables.read_table(spark, f"{layer}.nothing_yet"),
        "failing_checks": lambda: pipeline.run_pipeline(spark, readings, unclean, CONFIG, prefix=prefix),
    }
    rows = []
    for guard, attempt in attempts.items():
        try:
            attempt()
            stopped = None
        except (FileNotFoundError, RuntimeError) as error:
            stopped = type(error).__name__
        rows.append((guard, stopped, _marts_seen(spark, layer) == published))
    return spark.createDataFrame(rows, "guard string, stopped_by string, marts_unchanged boolean")


# --- readings -------------------------------------------------------------------------


def channel_quality(spark, sf_dir) -> DataFrame:
    ranked = quality.channel_quality(staged_readings(spark, sf_dir), CONFIG)
    return ranked.withColumns(rounded("reading_stddev", "reading_mean"))


def selected_channels(spark, sf_dir) -> DataFrame:
    return quality.selected_channels(
        quality.channel_quality(staged_readings(spark, sf_dir), CONFIG)
    ).select("sensor_id", "sensor_rank")


def selected_readings(spark, sf_dir) -> DataFrame:
    staged = staged_readings(spark, sf_dir)
    ranked = quality.channel_quality(staged, CONFIG)
    return quality.selected_readings(staged, quality.selected_channels(ranked))


def channel_median(spark, sf_dir) -> DataFrame:
    return impute.channel_median(staged_readings(spark, sf_dir))


def channel_median_counted(spark, sf_dir) -> DataFrame:
    """The median of channels beyond one task's memory, forced on whatever size is given."""
    return impute.channel_median(
        staged_readings(spark, sf_dir),
        in_memory_values=0,
        single_task_rows=1_000,
        sketched_channels=0,
    )


def channel_median_sketched(spark, sf_dir) -> DataFrame:
    """The median of channels of any size, from a sketched bracket and one count."""
    return impute.sketched_median(staged_readings(spark, sf_dir), single_task_rows=1_000)


def median_impute(spark, sf_dir) -> DataFrame:
    staged, fills = feature_parts(spark, sf_dir)
    return impute.median_impute(staged, fills)


def wafer_features(spark, sf_dir) -> DataFrame:
    staged, fills = feature_parts(spark, sf_dir)
    return features.wafer_features(
        impute.median_impute(staged, fills, keep_rank=True), CONFIG
    )


def wafer_features_wide(spark, sf_dir) -> DataFrame:
    _, fills = feature_parts(spark, sf_dir)
    return features.wafer_features_wide(raw_matrix(spark, sf_dir), fills, CONFIG)


def feature_mart(spark, sf_dir) -> DataFrame:
    """From long readings, as the given ids are not row numbers and may repeat."""
    return features.ml_features(
        wafer_features(spark, sf_dir), staged_labels(spark, sf_dir), CONFIG
    )


def ml_features(spark, sf_dir) -> DataFrame:
    return feature_mart(spark, sf_dir).drop("feature_set_built_at")


def feature_stamp(spark, sf_dir) -> DataFrame:
    """The build stamp of the feature mart, given as a parameter."""
    mart = features.ml_features(
        wafer_features(spark, sf_dir),
        staged_labels(spark, sf_dir),
        CONFIG,
        built_at=F.lit(BUILT_AT).cast("timestamp_ntz"),
    )
    return mart.select("wafer_id", "feature_set_built_at")


def feature_columns(spark, sf_dir) -> DataFrame:
    """Names and order of the feature columns of the mart, with the values each one has."""
    mart = ml_features(spark, sf_dir)
    cells = [
        F.struct(
            F.lit(place).alias("place"), F.lit(name).alias("feature"), F.count(name).alias("filled")
        )
        for place, name in enumerate(train.feature_columns(mart), start=1)
    ]
    return mart.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


# --- labels and quality checks ------------------------------------------------------------


def daily_yield(spark, sf_dir) -> DataFrame:
    return yields.daily_yield(staged_labels(spark, sf_dir), CONFIG)


def yield_summary(spark, sf_dir) -> DataFrame:
    return yields.yield_summary(staged_labels(spark, sf_dir), CONFIG)


def dq_not_null(spark, sf_dir) -> DataFrame:
    return dq.not_null_counts(
        staged_labels(spark, sf_dir), ["wafer_id", "yield_status", "is_fail", "tested_at"]
    )


def dq_unique(spark, sf_dir) -> DataFrame:
    return dq.unique(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def dq_accepted_values(spark, sf_dir) -> DataFrame:
    return dq.accepted_values(staged_labels(spark, sf_dir), "yield_status", ["pass", "fail"])


def dq_report(spark, sf_dir) -> DataFrame:
    """The whole suite over the derived tables, which fail some of its checks.

    Labels are checked many times, so they are a table, as in a run; of the
    feature rows the checks read little more than the key.
    """
    staged = staged_readings(spark, sf_dir)
    tested = stage_table(staged_labels(spark, sf_dir), "labels")
    ranked = quality.channel_quality(staged, CONFIG)
    fills = impute.fill_channels(ranked, staged)
    rows = features.wafer_features(
        impute.median_impute(staged, fills, keep_rank=True), CONFIG
    )
    return dq.run_suite(
        {
            "staged_readings": staged,
            "staged_labels": tested,
            "sensor_quality": ranked,
            "wafer_features": rows,
            "daily_yield": yields.daily_yield(tested, CONFIG),
            "yield_summary": yields.yield_summary(tested, CONFIG),
            "ml_features": features.ml_features(rows, tested, CONFIG),
        },
        PIPELINE_CHECKS,
    )


# --- streams ----------------------------------------------------------------------------------

# Trees of the forest that is saved and loaded; what is checked holds for any number.
ROUNDTRIP_TREES = 20
# Numbers in a vector of the encoder that stands for an external one.
HOOK_WIDTH = 32
# Deliveries of the streamed log: one label in so many comes after all others.
LATE_EVERY = 50


def deliver_labels(spark, sf_dir, folder: str, late: bool) -> None:
    """Append one delivery of label log files with wafer keys; some labels are unreadable."""
    label = F.when(F.col("wafer_id") % 89 == 0, "none").otherwise(F.col("pass_fail_raw").cast("string"))
    line = F.concat(
        F.col("wafer_id").cast("string"), F.lit("\t"), label, F.lit(' "'), "timestamp_str", F.lit('"')
    )
    delivered = raw_labels(spark, sf_dir).where((F.col("wafer_id") % LATE_EVERY == 0) == late)
    delivered.select(line.alias("value")).write.mode("append").text(folder)


def streamed_labels(spark, sf_dir) -> DataFrame:
    """The label table that a stream appends to: ended after the first delivery, then resumed."""
    folder, path, checkpoint = (
        scratch_path(spark, name) for name in ("label-log", "streamed-labels", "label-checkpoint")
    )
    for late in (False, True):
        deliver_labels(spark, sf_dir, folder, late)
        label_streams.ingest_labels(spark, folder, path, checkpoint).awaitTermination()
    return spark.read.parquet(path)


def streamed_daily_yield(spark, sf_dir) -> DataFrame:
    """The KPIs of closed days from the same deliveries; what comes for a closed day is late."""
    folder, path, checkpoint = (
        scratch_path(spark, name) for name in ("label-log", "streamed-yield", "yield-checkpoint")
    )
    for late in (False, True):
        deliver_labels(spark, sf_dir, folder, late)
        read = label_streams.accepted(label_streams.label_stream(spark, folder))
        days = yield_streams.daily_yield_stream(yields.stage_labels(read, CONFIG), CONFIG)
        label_streams.append_stream(days, path, checkpoint).awaitTermination()
    return spark.read.parquet(path)


# --- evaluation and training ----------------------------------------------------------------


def confusion_matrix(spark, sf_dir) -> DataFrame:
    return evaluate.confusion_matrix(evaluation(spark, sf_dir))


def binary_prf(spark, sf_dir) -> DataFrame:
    return evaluate.binary_prf(evaluation(spark, sf_dir)).withColumns(
        rounded("precision", "recall", "f1_score")
    )


def classification_report(spark, sf_dir) -> DataFrame:
    return evaluate.classification_report(evaluation(spark, sf_dir)).withColumns(
        rounded("precision", "recall", "f1_score")
    )


def roc_auc(spark, sf_dir) -> DataFrame:
    return evaluate.roc_auc(evaluation(spark, sf_dir)).withColumns(rounded("roc_auc"))


def split_labels(spark, sf_dir) -> DataFrame:
    return train.stratified_split(
        table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "quality"
    )


def hashed_split(spark, sf_dir) -> DataFrame:
    """The split that needs no counting: each labelled document by the hash of its id."""
    labelled = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return train.stratified_split(labelled, "doc_id", "quality", exact=False)


def label_profile(spark, sf_dir) -> DataFrame:
    return evaluate.label_profile(split_labels(spark, sf_dir), "quality", "split")


def class_weights(spark, sf_dir) -> DataFrame:
    return train.class_weights(table(spark, sf_dir, "labels"), "quality").withColumns(
        rounded("class_weight")
    )


def metrics_record(spark, sf_dir) -> DataFrame:
    scored = evaluation(spark, sf_dir)
    record = evaluate.metrics_record(scored, scored, [], target="truth", split=None)
    return record.select(
        "rows_total",
        "positive_rate_pct",
        "f1_fail_class",
        "roc_auc",
        "precision_fail",
        "recall_fail",
        F.to_json("confusion_matrix").alias("confusion_matrix"),
        F.round(F.col("classification_report")["accuracy"]["f1_score"], 6).alias("accuracy"),
    )


def _trained(spark, sf_dir):
    written = stage_table(feature_mart(spark, sf_dir), "ml-features")
    mart = train.with_target(written, drop_unlabelled=True)
    split = train.stratified_split(mart)
    names = train.feature_columns(split)
    learned = split.where("split = 'train'")
    fills = train.fill_values(learned, names)
    return train.train_forest(learned, names, fills=fills), split, names, fills


def train_forest(spark, sf_dir) -> DataFrame:
    """What is fixed about the fitted forest, whatever its random draws."""
    model, split, _, _ = _trained(spark, sf_dir)
    shape = F.lit(max(tree.depth for tree in model.trees) <= train.DEPTH)
    return split.agg(
        F.count(F.when(F.col("split") == "train", 1)).alias("train_rows"),
        F.lit(len(model.trees)).cast("long").alias("trees"),
        F.lit(model.numClasses).cast("long").alias("classes"),
        F.lit(model.numFeatures).cast("long").alias("features"),
        shape.alias("within_depth"),
    )


def score_batch(spark, sf_dir) -> DataFrame:
    """The scored test rows: each score a probability, each prediction its larger side."""
    model, split, names, fills = _trained(spark, sf_dir)
    scored = train.score_batch(model, split.where("split = 'test'"), names, fills)
    return scored.select(
        "wafer_id",
        "is_fail",
        F.col("score").between(0, 1).alias("is_probability"),
        ((F.col("score") > 0.5).cast("int") == F.col("prediction")).alias("agrees"),
    )


def model_roundtrip(spark, sf_dir) -> DataFrame:
    """A run saved and loaded again: whether each test row scores as it did before."""
    mart = stage_table(feature_mart(spark, sf_dir), "ml-features")
    run = pipeline.train_and_evaluate(
        train.with_target(mart, drop_unlabelled=True), trees=ROUNDTRIP_TREES
    )
    folder = scratch_path(spark, "run")
    pipeline.save_run(run, folder)
    outcome = ["prediction", "score"]
    again = pipeline.load_scorer(spark, folder).score(run.scored.drop(*outcome))
    return (
        again.select("wafer_id", *outcome)
        .unionByName(run.scored.select("wafer_id", *outcome))
        .groupBy("wafer_id")
        .agg(
            F.count(F.lit(1)).alias("scorings"),
            F.count_distinct("score", "prediction").alias("results"),
        )
    )


def top_features(spark, sf_dir) -> DataFrame:
    """What is fixed about the most important features."""
    model, _, names, _ = _trained(spark, sf_dir)
    top = train.top_features(spark, model, names)
    later = F.lag("importance").over(Window.orderBy(F.desc("importance"), "feature"))
    return (
        top.withColumn("_before", later)
        .agg(
            F.count_distinct("feature").alias("names"),
            F.bool_and(F.col("feature").isin(names)).alias("all_features"),
            F.bool_and(F.col("importance").between(0, 1)).alias("all_shares"),
            F.bool_and(F.coalesce(F.col("importance") <= F.col("_before"), F.lit(True))).alias("descending"),
            (F.sum("importance") <= 1 + 1e-9).alias("parts_of_one"),
        )
    )


# --- catalog and search -----------------------------------------------------------------------


def _flat(docs: DataFrame) -> DataFrame:
    entry = {name: F.element_at("metadata", name) for name in ("name", "model", "title")}
    return docs.select(
        "id",
        "text",
        F.element_at("metadata", "type").alias("doc_type"),
        F.coalesce(*entry.values()).alias("doc_name"),
        F.element_at("metadata", "column").alias("doc_column"),
    )


def catalog_docs(spark, sf_dir) -> DataFrame:
    """Each document as a described table, its lines as the described columns."""
    catalog = table(spark, sf_dir, "documents").select(
        F.format_string("doc_%d", "doc_id").alias("name"),
        F.col("source").alias("description"),
        F.transform(
            F.split("text", LINE),
            lambda line, i: F.struct(
                F.format_string("line_%03d", i + 1).alias("name"), line.alias("description")
            ),
        ).alias("columns"),
    )
    return _flat(documents.catalog_docs(catalog))


def line_chunks(spark, sf_dir) -> DataFrame:
    return documents.doc_chunks(
        table(spark, sf_dir, "documents"), key="doc_id", delimiter=LINE
    )


def doc_chunks(spark, sf_dir) -> DataFrame:
    return _flat(line_chunks(spark, sf_dir))


def corpus(spark, sf_dir) -> DataFrame:
    """Sources as tables, documents as their columns, and all text chunks."""
    docs = table(spark, sf_dir, "documents")
    sources = docs.groupBy("source").agg(
        F.format_string("%d documents", F.count(F.lit(1))).alias("description")
    )
    columns = docs.withColumn("column", F.format_string("doc_%d", "doc_id"))
    return documents.catalog_corpus(
        documents.model_docs(sources, "source"),
        documents.column_docs(columns, "source", "column", "text"),
        line_chunks(spark, sf_dir),
    )


def catalog_corpus(spark, sf_dir) -> DataFrame:
    return _flat(corpus(spark, sf_dir))


def index_manifest(spark, sf_dir) -> DataFrame:
    return documents.index_manifest(corpus(spark, sf_dir), COLLECTION, ENCODER)


def embed_text(spark, sf_dir) -> DataFrame:
    """The vector of every text, as one row for each place that is not zero."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    embedded, _ = search.fit_and_embed(docs)
    entry = lambda weight, place: F.when(weight != 0, F.struct(place, weight))
    entries = F.array_compact(F.transform("embedding", entry))
    return embedded.select("doc_id", F.inline(entries).alias("place", "weight")).withColumn(
        "weight", F.round(F.col("weight").cast("double"), 5)
    )


def load_word_encoder() -> Callable[[list[str]], list]:
    """An encoder as one would be loaded from outside: shares of a text's words by hash."""

    def encode(texts: list[str]) -> list:
        vectors = []
        for text in texts:
            words = text.split(" ")
            vector = [0.0] * HOOK_WIDTH
            for word in words:
                vector[search.word_slot(word, HOOK_WIDTH)] += 1 / len(words)
            vectors.append(vector)
        return vectors

    return encode


def embed_external(spark, sf_dir) -> DataFrame:
    """Vectors of the encoder hook, as one row for each place that is not zero."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    embedded = search.embed_with(docs, load_word_encoder)
    return embedded.select("doc_id", F.posexplode("embedding").alias("place", "weight")).where(
        "weight <> 0"
    ).withColumn("weight", F.round(F.col("weight").cast("double"), 5))


def label_centres(vectors: DataFrame) -> DataFrame:
    """The mean vector of each label: as many queries as there are labels."""
    as_vector = array_to_vector(F.col("embedding").cast("array<double>"))
    return vectors.groupBy(F.col("label").alias("query_id")).agg(
        vector_to_array(Summarizer.mean(as_vector)).alias("embedding")
    )


def _centre_neighbours(spark, sf_dir) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return search.knn_search(
        vectors.select(F.col("vec_id").alias("id"), "embedding"), label_centres(vectors)
    )


def knn_search(spark, sf_dir) -> DataFrame:
    return _centre_neighbours(spark, sf_dir).withColumns(rounded("distance"))


def knn_approximate(spark, sf_dir) -> DataFrame:
    """Each twentieth vector's neighbours by hash tables: how many, and whether they hold.

    Distances must be those of the vectors, and nine tenths of all exact
    neighbours must be found, not counting the vector itself.
    """
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    asked = vectors.where("id % 20 = 0").withColumnRenamed("id", "query_id")
    others = F.col("id") != F.col("query_id")
    found = neighbours.knn_approximate(vectors, asked, NEIGHBOURS + 1).where(others)
    exact = search.knn_search(vectors, asked, NEIGHBOURS + 1).where(others)
    first = F.col("rank") <= NEIGHBOURS + 1
    share = neighbours.recall_of(found, exact.where(first)).first()["recall"]
    target = asked.withColumnRenamed("embedding", "_target")
    gap = F.zip_with("embedding", "_target", lambda a, b: (a.cast("double") - b) * (a.cast("double") - b))
    again = F.aggregate(gap, F.lit(0.0), lambda total, part: total + part)
    return (
        found.join(vectors, "id")
        .join(target, "query_id")
        .withColumn("_holds", F.abs(again - F.col("distance")) < 1e-9)
        .groupBy("query_id")
        .agg(F.count(F.lit(1)).alias("neighbours"), F.bool_and("_holds").alias("distances_hold"))
        .withColumn("recall_reached", F.lit(share >= 0.9))
    )


def search_hits(spark, sf_dir) -> DataFrame:
    entries = [F.lit("source"), F.col("source"), F.lit("lang"), F.col("lang")]
    typed = F.create_map(*entries, F.lit("type"), F.col("lang"))
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        "text",
        F.when(F.col("lang") != "en", typed).otherwise(F.create_map(*entries)).alias("metadata"),
    )
    hits = search.search_hits(_centre_neighbours(spark, sf_dir), docs)
    return hits.select(
        "query_id",
        "rank",
        "id",
        "document",
        F.element_at("metadata", "source").alias("source"),
        F.round("distance", 6).alias("distance"),
        "headline",
        "distance_text",
    )


def text_search(spark, sf_dir) -> DataFrame:
    """Questions in plain words against the text of all documents."""
    docs = table(spark, sf_dir, "documents").select(
        F.format_string("doc::%d", "doc_id").alias("id"),
        "text",
        F.create_map(F.lit("lang"), F.col("lang")).alias("metadata"),
    )
    questions = spark.createDataFrame(list(enumerate(QUESTIONS)), "query_id int, text string")
    index, encoder = search.fit_and_embed(docs)
    hits = search.search(stage_table(index, "text-index"), questions, encoder)
    return hits.drop("metadata").withColumns(rounded("distance", digits=5)).drop("distance_text")


QUERIES: dict[str, Query] = {
    "read_matrix": read_matrix,
    "row_ordinal": row_ordinal,
    "parse_labels": parse_labels,
    "bronze_write": bronze_write,
    "ingest_audit": ingest_audit,
    "distinct_users": distinct_users,
    "melt_long": melt_long,
    "nullify_sentinel": staged_readings,
    "channel_quality": channel_quality,
    "selected_channels": selected_channels,
    "selected_readings": selected_readings,
    "channel_median": channel_median,
    "channel_median_counted": channel_median_counted,
    "channel_median_sketched": channel_median_sketched,
    "median_impute": median_impute,
    "wafer_features": wafer_features,
    "wafer_features_wide": wafer_features_wide,
    "ml_features": ml_features,
    "feature_stamp": feature_stamp,
    "feature_columns": feature_columns,
    "published_marts": published_marts,
    "mart_read": mart_read,
    "index_rebuild": index_rebuild,
    "guard_report": guard_report,
    "label_staging": staged_labels,
    "daily_yield": daily_yield,
    "yield_summary": yield_summary,
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_accepted_values": dq_accepted_values,
    "dq_report": dq_report,
    "streamed_labels": streamed_labels,
    "streamed_daily_yield": streamed_daily_yield,
    "confusion_matrix": confusion_matrix,
    "binary_prf": binary_prf,
    "classification_report": classification_report,
    "roc_auc": roc_auc,
    "label_profile": label_profile,
    "stratified_split": split_labels,
    "hashed_split": hashed_split,
    "class_weights": class_weights,
    "metrics_record": metrics_record,
    "train_forest": train_forest,
    "score_batch": score_batch,
    "top_features": top_features,
    "model_roundtrip": model_roundtrip,
    "catalog_docs": catalog_docs,
    "doc_chunks": doc_chunks,
    "catalog_corpus": catalog_corpus,
    "index_manifest": index_manifest,
    "embed_text": embed_text,
    "embed_external": embed_external,
    "knn_search": knn_search,
    "knn_approximate": knn_approximate,
    "search_hits": search_hits,
    "text_search": text_search,
}
