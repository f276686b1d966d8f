"""The places where a plausible shortcut would change results."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from waferlens.config import PipelineConfig, feature_names
from waferlens.functions.columns import (
    BLANK_CHARACTERS,
    parse_test_time,
    percentage,
    round_half_away,
    snippet,
)
from waferlens.operators import dq, evaluate, features, impute, quality, reshape, train, yields
from waferlens.sources import documents, labels, matrix

READING = "wafer_id long, sensor_id int, reading_value double"


def readings(spark, rows):
    return spark.createDataFrame(rows, READING)


def values_of(df, key, *columns):
    return {r[key]: tuple(r[c] for c in columns) for r in df.collect()}


def test_nan_sentinel_and_null_are_missing_but_flagged_apart(spark):
    rows = [(1, 1, math.nan), (2, 1, -200.0), (3, 1, None), (4, 1, 1.5)]
    staged = quality.stage_readings(readings(spark, rows))
    assert values_of(staged, "wafer_id", "reading_value", "is_imputed_source_missing") == {
        1: (None, False),
        2: (None, True),
        3: (None, False),
        4: (1.5, False),
    }


def test_sentinel_is_a_parameter(spark):
    staged = quality.stage_readings(
        readings(spark, [(1, 1, -200.0), (2, 1, -1.0)]), PipelineConfig(sentinel=-1.0)
    )
    assert values_of(staged, "wafer_id", "reading_value") == {1: (-200.0,), 2: (None,)}


def test_percentages_are_doubles_rounded_as_binary_numbers(spark):
    row = spark.range(1).select(
        percentage(F.lit(1), F.lit(3)).alias("p"),
        percentage(F.lit(0), F.lit(0)).alias("empty"),
        round_half_away(F.lit(1.005), 2).alias("tie"),
        round_half_away(F.lit(-2.5), 0).alias("negative"),
    )
    assert dict(row.dtypes)["p"] == "double"
    assert tuple(row.first()) == (33.33, None, 1.0, -3.0)


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("19/07/2008 11:55:00", dt.datetime(2008, 7, 19, 11, 55)),
        ("9/7/2008 1:02:03", dt.datetime(2008, 7, 9, 1, 2, 3)),
        ("  9/7/2008   1:2:3 ", dt.datetime(2008, 7, 9, 1, 2, 3)),
        ("19/07/08 1:2:3", dt.datetime(8, 7, 19, 1, 2, 3)),
        ("19/07/2008", None),
        ("31/02/2008 00:00:00", None),
        ("29/02/2008 00:00:00", dt.datetime(2008, 2, 29)),
        ("19/19/2008 00:00:00", None),
        ("19/07/2008 24:00:00", None),
        ("19/07/2008 11:55:60", None),
        ("19/07/20089 00:00:00", None),
        ("2008-07-19 11:55:00", None),
        ("bad", None),
        ("", None),
        (None, None),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_lenient_times_do_not_depend_on_the_session_zone(spark, text, expected, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(text,)], "t string").select(parse_test_time(F.col("t")))
        assert df.dtypes[0][1] == "timestamp_ntz"
        assert df.first()[0] == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_times_inside_a_clock_change_survive(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("9/3/2008 02:30:00",)], "t string")
        assert df.select(parse_test_time(F.col("t"))).first()[0] == dt.datetime(2008, 3, 9, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def label_rows(spark):
    return yields.stage_labels(
        spark.createDataFrame(
            [
                (1, -1, "1/1/2020 0:0:0"),
                (2, 1, "1/1/2020 1:0:0"),
                (3, 0, "1/1/2020 2:0:0"),
                (4, 0, "2/1/2020 2:0:0"),
                (5, -1, "bad"),
                (6, None, "1/1/2020 3:0:0"),
            ],
            "wafer_id long, pass_fail_raw int, timestamp_str string",
        )
    )


def test_labels_map_to_status_and_target(spark):
    staged = label_rows(spark)
    assert values_of(staged, "wafer_id", "yield_status", "is_fail") == {
        1: ("fail", 1),
        2: ("pass", 0),
        3: ("unknown", None),
        4: ("unknown", None),
        5: ("fail", 1),
        6: ("unknown", None),
    }


def test_unknown_labels_count_as_passed_unless_excluded(spark):
    days = values_of(
        yields.daily_yield(label_rows(spark)),
        "test_date", "wafer_count", "fail_count", "pass_count", "fail_rate_pct",
    )
    assert days[dt.date(2020, 1, 1)] == (4, 1, 3, 25.0)
    # Nothing but unknown labels: no fails to sum, so no rates either.
    assert days[dt.date(2020, 1, 2)] == (1, None, None, None)
    strict = values_of(
        yields.daily_yield(label_rows(spark), PipelineConfig(unknown_as_pass=False)),
        "test_date", "wafer_count", "fail_count", "pass_count", "fail_rate_pct",
    )
    assert strict[dt.date(2020, 1, 1)] == (2, 1, 1, 50.0)


def test_untimed_labels_are_in_the_summary_but_in_no_day(spark):
    staged = label_rows(spark)
    daily = yields.daily_yield(staged).agg(F.sum("wafer_count")).first()[0]
    summary = yields.yield_summary(staged).first()
    assert (daily, summary["total_wafers"]) == (5, 6)
    assert summary["first_test_at"] == dt.datetime(2020, 1, 1)
    assert summary["last_test_at"] == dt.datetime(2020, 1, 2, 2)


def test_summary_of_no_labels_is_one_row_of_nulls(spark):
    row = yields.yield_summary(label_rows(spark).where("wafer_id < 0")).first()
    assert (row["total_wafers"], row["total_fails"], row["overall_yield_rate_pct"]) == (0, None, None)


def channel(spark, sensor, values):
    return [(i, sensor, v) for i, v in enumerate(values)]


def test_ranking_ties_nulls_and_over_limit_channels(spark):
    rows = (
        channel(spark, 5, [1.0, 1.0, 1.0, 1.0])
        + channel(spark, 4, [2.0, 2.0, 2.0, 2.0])
        + channel(spark, 3, [9.0])
        + channel(spark, 2, [0.0, 900.0, None, None])
        + channel(spark, 1, [1.0, 2.0, 3.0, 4.0])
    )
    ranked = quality.channel_quality(readings(spark, rows), PipelineConfig(top_sensors=5))
    by_sensor = values_of(ranked, "sensor_id", "sensor_rank", "is_selected_for_ml")
    # Spread first, equal spread by id, a single reading after all, too many gaps last;
    # but a channel over the limit is still selected while there is room.
    assert by_sensor == {1: (1, True), 4: (2, True), 5: (3, True), 3: (4, True), 2: (5, True)}
    strict = quality.channel_quality(
        readings(spark, rows), PipelineConfig(top_sensors=5, strict_null_filter=True)
    )
    assert values_of(strict, "sensor_id", "is_selected_for_ml")[2] == (False,)


def test_the_null_limit_is_inclusive_on_the_rounded_percentage(spark):
    # 7 of 20 missing is exactly 35 %; 35.004 % rounds to it.
    profile = spark.createDataFrame(
        [(1, 35.0, 1.0), (2, 35.01, 9.0)],
        "sensor_id int, null_pct double, reading_stddev double",
    )
    ranked = quality.rank_channels(profile, PipelineConfig(top_sensors=1))
    assert values_of(ranked, "sensor_id", "sensor_rank") == {1: (1,), 2: (2,)}


def test_all_nan_channel_is_empty_not_first(spark):
    rows = channel(spark, 1, [math.nan] * 3) + channel(spark, 2, [1.0, 2.0, 3.0])
    staged = quality.stage_readings(readings(spark, rows))
    ranked = quality.channel_quality(staged)
    assert values_of(ranked, "sensor_id", "sensor_rank", "null_pct", "reading_mean") == {
        1: (2, 100.0, None),
        2: (1, 0.0, 2.0),
    }


def test_median_interpolates_and_missing_channel_stays_missing(spark):
    rows = channel(spark, 1, [1.0, 2.0, 4.0, 10.0, None]) + channel(spark, 2, [None, None])
    staged = readings(spark, rows)
    config = PipelineConfig(top_sensors=2, max_null_fraction=1.0)
    fills = impute.fill_channels(quality.channel_quality(staged, config), staged)
    assert values_of(fills, "sensor_id", "sensor_median") == {1: (3.0,), 2: (None,)}
    filled = impute.median_impute(staged, fills)
    found = {(r["sensor_id"], r["wafer_id"]): (r["reading_value"], r["was_imputed"]) for r in filled.collect()}
    assert found[(1, 4)] == (3.0, True)
    assert found[(1, 0)] == (1.0, False)
    assert found[(2, 0)] == (None, True)


def test_melt_keeps_missing_readings_and_unifies_types(spark):
    wide = spark.createDataFrame(
        [(1, 3, 1.5), (2, None, None)], "wafer_id long, sensor_001 int, sensor_002 double"
    )
    long = reshape.melt_columns(wide)
    assert long.dtypes == [("wafer_id", "bigint"), ("sensor_id", "int"), ("reading_value", "double")]
    assert sorted(map(tuple, long.collect()), key=lambda r: r[:2]) == [
        (1, 1, 3.0), (1, 2, 1.5), (2, 1, None), (2, 2, None),
    ]


def test_melt_array_equals_melt_columns(spark):
    arrays = spark.createDataFrame(
        [(1, [1.0, None]), (2, [None, 4.0])], "wafer_id long, values array<double>"
    )
    by_array = reshape.melt_array(arrays)
    by_column = reshape.melt_columns(matrix.widen(arrays, 2))
    assert sorted(map(repr, by_array.collect())) == sorted(map(repr, by_column.collect()))


def test_one_parameter_drives_selection_and_features(spark):
    rows = [(w, s, float(w * s)) for w in range(5) for s in range(1, 8)]
    rows[3] = (*rows[3][:2], None)
    staged = readings(spark, rows)
    for count in (2, 7, 9):
        config = PipelineConfig(top_sensors=count)
        fills = impute.fill_channels(quality.channel_quality(staged, config), staged)
        long = features.wafer_features(
            impute.median_impute(staged, fills, keep_rank=True), config
        )
        assert train.feature_columns(long) == feature_names(count)
        arrays = staged.groupBy("wafer_id").agg(
            F.transform(
                F.sort_array(F.collect_list(F.struct("sensor_id", "reading_value"))),
                lambda pair: pair["reading_value"],
            ).alias("values")
        )
        wide = features.wafer_features_wide(arrays, fills, config)
        assert wide.dtypes == long.dtypes
        assert sorted(map(repr, wide.collect())) == sorted(map(repr, long.collect()))


def test_imputed_output_has_no_gaps_unless_a_channel_is_empty(spark):
    rows = [(w, s, None if (w + s) % 3 == 0 else float(w)) for w in range(9) for s in (1, 2, 3)]
    staged = readings(spark, rows)
    config = PipelineConfig(top_sensors=3)
    fills = impute.fill_channels(quality.channel_quality(staged, config), staged)
    assert impute.median_impute(staged, fills).where("reading_value is null").isEmpty()


def test_mart_keeps_labelled_wafers_only(spark):
    config = PipelineConfig(top_sensors=1)
    rows = spark.createDataFrame([(1, 0, 0, 1.0), (9, 0, 0, 2.0)],
                                 "wafer_id long, any_imputed_flag int, imputed_sensor_count long, feature_001 double")
    built = dt.datetime(2024, 1, 1)
    mart = features.ml_features(rows, label_rows(spark), config, built_at=F.lit(built))
    row = mart.collect()
    assert [r["wafer_id"] for r in row] == [1]
    assert row[0]["test_date"] == dt.date(2020, 1, 1)
    assert row[0]["feature_set_built_at"] == built


def test_duplicate_labels_multiply_rows_and_the_suite_sees_it(spark):
    twice = label_rows(spark).unionByName(label_rows(spark))
    rows = spark.createDataFrame([(1, 0, 0, 1.0)],
                                 "wafer_id long, any_imputed_flag int, imputed_sensor_count long, feature_001 double")
    mart = features.ml_features(rows, twice, PipelineConfig(top_sensors=1))
    assert mart.count() == 2
    report = dq.run_suite({"mart": mart}, [dq.Check("unique", "mart", "wafer_id")])
    assert report.first()["failures"] == 1
    with pytest.raises(dq.DataQualityError, match="unique:mart.wafer_id"):
        dq.require_clean(report)


def test_checks_ignore_nulls_where_they_should(spark):
    df = spark.createDataFrame(
        [(1, "a"), (1, "x"), (None, None), (None, None), (2, "x")], "k int, v string"
    )
    checks = [
        dq.Check("unique", "t", "k"),
        dq.Check("not_null", "t", "k"),
        dq.Check("not_null", "t", "v"),
        dq.Check("accepted_values", "t", "v", ("a",)),
    ]
    report = values_of(dq.run_suite({"t": df}, checks), "test", "failures")
    assert report == {
        "unique:t.k": (1,),
        "not_null:t.k": (2,),
        "not_null:t.v": (2,),
        "accepted_values:t.v": (1,),
    }
    assert dq.not_null(df, "k").count() == 2
    assert [tuple(r) for r in dq.accepted_values(df, "v", ["a"]).collect()] == [("x", 2)]
    empty = values_of(dq.run_suite({"t": df.limit(0)}, checks), "test", "failures")
    assert set(empty.values()) == {(0,)}
    dq.require_clean(dq.run_suite({"t": df.limit(0)}, checks))


@pytest.mark.parametrize(
    ("line", "label", "timestamp"),
    [
        ('-1 "19/07/2008 11:55:00"', "-1", "19/07/2008 11:55:00"),
        ('  1  " 19/07/2008 11:55:00 "  ', "1", "19/07/2008 11:55:00"),
        ("1 20/07/2008 10:00:00", "1", "20/07/2008"),
        ("1", "1", None),
        ('1 "a"b"c"', "1", "abc"),
        ('1 "open', "1", "open"),
    ],
)
def test_label_lines(spark, line, label, timestamp):
    df = spark.createDataFrame([(line,)], "value string")
    row = labels.split_label_lines(df).first()
    assert (row["label_text"], row["timestamp_str"]) == (label, timestamp)


def test_matrix_tokens(spark):
    df = spark.createDataFrame([(" 1 -2.5e3\tNaN  NA nan -200 ",)], "value string")
    assert df.select(matrix.parse_values(F.col("value"))).first()[0] == [
        1.0, -2500.0, None, None, None, -200.0,
    ]
    with pytest.raises(Exception, match="not a number in matrix: x1"):
        spark.createDataFrame([("1 x1",)], "value string").select(
            matrix.parse_values(F.col("value"))
        ).collect()


GOLDEN = {(0, 0): 0, (0, 1): 21, (1, 0): 2, (1, 1): 291}


def golden(spark):
    rows = [cell for cell, n in GOLDEN.items() for _ in range(n)]
    return spark.createDataFrame(rows, "truth int, prediction int")


def test_recorded_confusion_gives_recorded_scores(spark):
    scored = golden(spark)
    cells = {(r["truth"], r["prediction"]): r["n"] for r in evaluate.confusion_matrix(scored).collect()}
    assert cells == GOLDEN
    prf = evaluate.binary_prf(scored).first()
    assert [round(x, 4) for x in prf] == [0.9327, 0.9932, 0.962]
    report = values_of(
        evaluate.classification_report(scored), "label", "precision", "recall", "f1_score", "support"
    )
    assert report["0"] == (0.0, 0.0, 0.0, 21)
    assert report["1"] == pytest.approx((0.9326923076923077, 0.9931740614334471, 0.9619834710743802, 293))
    assert report["accuracy"][2:] == (pytest.approx(0.9267515923566879), 314)
    assert report["macro avg"] == pytest.approx((0.46634615384615385, 0.49658703071672355, 0.4809917355371901, 314))
    assert report["weighted avg"] == pytest.approx((0.8703147966682998, 0.9267515923566879, 0.8976469968942464, 314))


def test_metrics_record_is_one_nested_json_row(spark, tmp_path):
    scored = golden(spark).withColumn("score", F.col("prediction") * 0.5)
    top = spark.createDataFrame([("feature_002", 0.7), ("feature_001", 0.3)], "feature string, importance double")
    record = evaluate.metrics_record(
        scored, scored, ["feature_001", "feature_002"], top, target="truth", split=None
    )
    row = record.first()
    assert row["confusion_matrix"] == [[0, 21], [2, 291]]
    assert (row["f1_fail_class"], row["precision_fail"], row["recall_fail"]) == (0.962, 0.9327, 0.9932)
    assert row["classification_report"]["0"]["support"] == 21
    assert row["top_features"][0]["feature"] == "feature_002"
    from waferlens.sources.tables import write_json

    write_json(record, str(tmp_path / "metrics"))
    assert spark.read.json(str(tmp_path / "metrics")).first()["rows_total"] == 314


def test_auc_counts_ties_half_and_needs_both_classes(spark):
    rows = [(1, 0.9), (0, 0.9), (1, 0.8), (0, 0.1), (0, 0.8), (1, 0.1), (1, 0.95)]
    df = spark.createDataFrame(rows, "truth int, score double")
    pos = [s for t, s in rows if t]
    neg = [s for t, s in rows if not t]
    expected = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert evaluate.roc_auc(df).first()[0] == pytest.approx(expected)
    assert evaluate.roc_auc(df.where("truth = 1")).first()[0] is None


def test_split_has_recorded_sizes_and_is_repeatable(spark):
    df = spark.range(1, 1568).select(
        F.col("id").alias("wafer_id"), (F.col("id") > 104).cast("int").alias("is_fail"), "id"
    )
    split = train.stratified_split(df)
    counts = {(r["split"], r["is_fail"]): r["n"] for r in split.groupBy("split", "is_fail").agg(F.count("*").alias("n")).collect()}
    assert counts == {("test", 0): 21, ("test", 1): 293, ("train", 0): 83, ("train", 1): 1170}
    again = train.stratified_split(df.repartition(5))
    assert split.exceptAll(again).isEmpty()
    other = train.stratified_split(df, seed=7)
    assert not split.exceptAll(other).isEmpty()


def test_class_weights_are_balanced(spark):
    df = spark.createDataFrame([(0,)] * 104 + [(1,)] * 1463, "is_fail int")
    weights = values_of(train.class_weights(df), "is_fail", "class_weight")
    assert weights == {0: (1567 / 208,), 1: (1567 / 2926,)}


def test_missing_target_is_an_error_unless_dropped(spark):
    df = spark.createDataFrame([(1, None), (2, 1)], "wafer_id long, is_fail int")
    assert train.with_target(df, drop_unlabelled=True).count() == 1
    with pytest.raises(Exception, match="is_fail is missing"):
        train.with_target(df).collect()


def test_chunks_are_numbered_after_blanks_are_dropped(spark):
    text = "# Title\nintro\n##  \n## First\nbody\n## Second"
    df = spark.createDataFrame([(text,)], "text string")
    rows = [tuple(r) for r in documents.doc_chunks(df).collect()]
    assert rows == [
        ("glossary::0", "# Title\nintro", {"type": "glossary", "title": "# Title"}),
        ("glossary::1", "First\nbody", {"type": "glossary", "title": "First"}),
        ("glossary::2", "Second", {"type": "glossary", "title": "Second"}),
    ]


def test_blanks_are_all_that_python_strips():
    assert "".join(c for c in map(chr, range(0x3001)) if c.isspace()) == BLANK_CHARACTERS


def test_missing_chunk_file_has_no_documents(spark, tmp_path):
    assert documents.read_chunks(spark, str(tmp_path / "none.md")).isEmpty()


def test_catalog_documents(spark):
    catalog = spark.createDataFrame(
        [("orders", " All orders. ", [("id", "Key."), ("note", None)]), ("empty", None, [])],
        "name string, description string, columns array<struct<name: string, description: string>>",
    )
    docs = values_of(documents.catalog_docs(catalog), "id", "text", "metadata")
    assert docs == {
        "model::orders": ("Model orders: All orders.", {"type": "model", "name": "orders"}),
        "model::empty": ("Model empty: ", {"type": "model", "name": "empty"}),
        "column::orders.id": (
            "Column id in model orders: Key.",
            {"type": "column", "model": "orders", "column": "id"},
        ),
        "column::orders.note": (
            "Column note in model orders: ",
            {"type": "column", "model": "orders", "column": "note"},
        ),
    }


def test_snippet_is_220_characters_and_a_tail(spark):
    df = spark.createDataFrame([("é" * 300,), ("short",)], "t string")
    assert [r[0] for r in df.select(snippet(F.col("t"))).collect()] == ["é" * 220 + "...", "short..."]
