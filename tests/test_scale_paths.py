"""The ways taken when data outgrow one task, against brute force on small data."""

import math
import os
import random
import re
import statistics
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from waferlens.config import PipelineConfig, feature_names
from waferlens.operators import evaluate, features, impute, ordering, quality, search, train
from waferlens.sources import labels, matrix, ordinals


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_ranged_running_sum_equals_one_window(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([0.0, 0.0, 0.0, rng.random()]), rng.randint(0, 9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, x double, n long").repartition(7)
    order = [F.col("x").desc_nulls_last(), "id"]
    one = ordering.running_sum(df, order, "n", "upto")
    many = ordering.running_sum(df, order, "n", "upto", single_task_rows=10)
    assert one.exceptAll(many).isEmpty()
    assert many.count() == 3000
    ranks = ordering.global_rank(df, order, "rank", single_task_rows=10)
    assert sorted(r[0] for r in ranks.select("rank").collect()) == list(range(1, 3001))


def median_rows():
    """One channel with a third of all rows, one almost constant, tiny ones, an empty one."""
    rng = random.Random(2)
    rows = [(i, 1, rng.gauss(0, 1)) for i in range(4000)]
    rows += [(i, 2, 5.0 if rng.random() < 0.9 else rng.random()) for i in range(2001)]
    rows += [(i, 3, float(rng.randint(0, 5))) for i in range(2000)]
    rows += [(i, 4, rng.choice([math.pi, None])) for i in range(500)]
    rows += [(0, 5, 7.0), (0, 6, 1.0), (1, 6, 4.0), (0, 7, None)]
    rows += [(i, s, rng.expovariate(1)) for s in range(8, 30) for i in range(150)]
    return rows


def expected_medians(rows):
    by_channel = {}
    for _, sensor, value in rows:
        by_channel.setdefault(sensor, [])
        if value is not None:
            by_channel[sensor].append(value)
    return {s: statistics.median(v) if v else None for s, v in by_channel.items()}


@pytest.mark.parametrize("single_task_rows", [1_000_000, 5])
@pytest.mark.parametrize("guess", ["right", "far off", "point", "not a number", "infinite"])
def test_counted_median_is_exact_under_skew_and_bad_guesses(
    spark, monkeypatch, single_task_rows, guess
):
    monkeypatch.setattr(impute, "BINS", 7)
    rows = median_rows()
    df = spark.createDataFrame(
        rows, "wafer_id long, sensor_id int, reading_value double"
    ).repartition(6)
    mean, stddev = {
        "right": (F.col("reading_mean"), F.col("reading_stddev")),
        "far off": (F.lit(1e9), F.lit(1.0)),
        "point": (F.lit(0.1), F.lit(0.0)),
        "not a number": (F.lit(math.nan), F.lit(1.0)),
        "infinite": (F.lit(0.0), F.lit(math.inf)),
    }[guess]
    spread = impute.value_spread(df).withColumns({"reading_mean": mean, "reading_stddev": stddev})
    found = impute.counted_median(df, spread, name="m", single_task_rows=single_task_rows)
    assert {r["sensor_id"]: r["m"] for r in found.collect()} == expected_medians(rows)


def test_infinite_readings_have_medians(spark):
    rows = [(i, 1, math.inf) for i in range(4)] + [(i, 1, float(i)) for i in range(7)]
    rows += [(i, 2, -math.inf) for i in range(3)]
    df = spark.createDataFrame(rows, "wafer_id long, sensor_id int, reading_value double")
    found = impute.channel_median(df, name="m", in_memory_values=0, single_task_rows=0)
    assert {r["sensor_id"]: r["m"] for r in found.collect()} == {1: 5.0, 2: -math.inf}


def test_large_channels_take_the_sliced_way(spark):
    rows = median_rows()
    df = spark.createDataFrame(rows, "wafer_id long, sensor_id int, reading_value double")
    small = impute.channel_median(df)
    large = impute.channel_median(df, in_memory_values=100)
    assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty()
    assert "percentile" not in plan(large)


def write_files(folder, files):
    folder.mkdir()
    for name, lines in files.items():
        (folder / name).write_bytes("".join(lines).encode())
    return str(folder)


def test_rows_are_numbered_in_file_order_over_many_blocks(spark, tmp_path):
    rng = random.Random(3)
    files, expected = {}, []
    for name in ("a.txt", "b.txt", "c.txt"):
        lines = []
        for i in range(700):
            if rng.random() < 0.1:
                lines.append(rng.choice(["\n", "   \n", "\r\n", "\t\n"]))
            text = f"{name} {i} " + "x" * rng.randint(0, 40)
            lines.append(text + rng.choice(["\n", "\r\n"]))
            expected.append(text)
        files[name] = lines
    path = write_files(tmp_path / "lines", files)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        lines = ordinals.read_lines(spark, path)
        assert lines.rdd.getNumPartitions() > 10
        for tasks, broadcast in ((1_000_000, 1_000_000), (3, 0)):
            numbered = ordinals.number_rows(
                lines, "n", single_task_rows=tasks, broadcast_blocks=broadcast
            )
            found = [r["value"] for r in sorted(numbered.collect(), key=lambda r: r["n"])]
            assert found == expected
            assert numbered.agg(F.min("n"), F.max("n")).first() == (1, len(expected))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_label_log_numbers_skip_blank_lines(spark, tmp_path):
    path = write_files(
        tmp_path / "log",
        {"l.data": ['-1 "19/07/2008 11:55:00"\r\n', "\r\n", "1 20/07/2008 10:00:00\r\n", "oops\n", '1 "x"']},
    )
    accepted, quarantined = labels.read_labels_quarantined(spark, path)
    assert sorted(map(tuple, accepted.collect())) == [
        (1, -1, "19/07/2008 11:55:00"), (2, 1, "20/07/2008"), (4, 1, "x"),
    ]
    assert [tuple(r) for r in quarantined.collect()] == [(3, "oops")]
    with pytest.raises(Exception, match="not an integer label: oops"):
        labels.read_labels(spark, path).collect()


def test_short_matrix_lines_are_padded_and_long_ones_refused(spark, tmp_path):
    path = write_files(tmp_path / "m", {"m.data": ["1 2 3\n", "\n", "4 NaN\n"]})
    rows = {r["wafer_id"]: r["values"] for r in matrix.read_matrix(spark, path).collect()}
    assert rows == {1: [1.0, 2.0, 3.0], 2: [4.0, None, None]}
    path = write_files(tmp_path / "bad", {"m.data": ["1 2\n", "1 2 3\n"]})
    with pytest.raises(ValueError, match="has 3 numbers, the first has 2"):
        matrix.read_matrix(spark, path)


def test_ranged_auc_equals_brute_force_with_a_heavy_score(spark):
    rng = random.Random(4)
    rows = [(rng.randint(0, 1), rng.choice([0.5, rng.random()])) for _ in range(600)]
    df = spark.createDataFrame(rows, "truth int, score double").repartition(5)
    pos = [s for t, s in rows if t]
    neg = [s for t, s in rows if not t]
    expected = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    for limit in (1_000_000, 10):
        assert evaluate.roc_auc(df, single_task_rows=limit).first()[0] == pytest.approx(expected)


def test_ranged_channel_ranks_equal_single_task_ranks(spark):
    rng = random.Random(5)
    rows = [(s, rng.choice([0.0, 0.0, 50.0]), rng.choice([0.0, None, rng.random()])) for s in range(900)]
    profile = spark.createDataFrame(rows, "sensor_id int, null_pct double, reading_stddev double")
    one = quality.rank_channels(profile)
    many = quality.rank_channels(profile, single_task_rows=10)
    assert one.exceptAll(many).isEmpty()


def test_nearest_neighbours_equal_brute_force_in_one_or_many_passes(spark):
    rng = np.random.default_rng(6)
    points = rng.integers(0, 3, size=(400, 4)).astype(float)
    queries = rng.integers(0, 3, size=(7, 4)).astype(float)
    docs = spark.createDataFrame(
        [(i, p.tolist()) for i, p in enumerate(points)], "id long, embedding array<float>"
    ).repartition(5)
    asked = spark.createDataFrame(
        [(f"q{i}", q.tolist()) for i, q in enumerate(queries)],
        "query_id string, embedding array<float>",
    )
    distances = ((points[None] - queries[:, None]) ** 2).sum(axis=2)
    expected = {
        (f"q{q}", rank, int(i), distances[q, i])
        for q in range(7)
        for rank, i in enumerate(np.lexsort((np.arange(400), distances[q]))[:6], start=1)
    }
    for per_pass in (1_000, 3):
        found = search.knn_search(docs, asked, 6, queries_per_pass=per_pass)
        assert {tuple(r) for r in found.collect()} == expected
    few = search.knn_search(docs.where("id < 2"), asked, 6)
    assert few.count() == 14
    with pytest.raises(Exception, match="vectors of 4 numbers"):
        search.knn_search(docs.withColumn("embedding", F.slice("embedding", 1, 3)), asked).collect()


def test_many_queries_pass_blocks_of_documents(spark):
    rng = np.random.default_rng(7)
    points = rng.integers(0, 4, size=(120, 3)).astype(float)
    docs = spark.createDataFrame(
        [(i, p.tolist()) for i, p in enumerate(points)], "id long, embedding array<float>"
    )

    def asked(count):
        queries = np.random.default_rng(8).integers(0, 4, size=(count, 3)).astype(float)
        rows = [(i, q.tolist()) for i, q in enumerate(queries)]
        return queries, spark.createDataFrame(rows, "query_id long, embedding array<float>")

    queries, many = asked(10_500)
    found = search.knn_search(docs, many, 2, rows_per_block=50)
    distances = ((points[None] - queries[:, None]) ** 2).sum(axis=2)
    order = np.argsort(distances, axis=1, kind="stable")[:, :2]
    expected = {
        (q, rank, int(i), distances[q, i])
        for q in range(len(queries))
        for rank, i in enumerate(order[q], start=1)
    }
    assert {tuple(r) for r in found.collect()} == expected
    _, fewer = asked(1_500)
    plans = [plan(search.knn_search(docs, some, 2, rows_per_block=50)) for some in (many, fewer)]
    assert len(plans[0].splitlines()) == len(plans[1].splitlines())


def test_medians_of_huge_readings_are_the_same_on_both_ways(spark):
    rows = [(0, 1, 1.7e308), (1, 1, 1.7e308), (0, 2, 1.6e308), (1, 2, 1.7e308), (0, 3, -1.7e308), (1, 3, 1.7e308)]
    df = spark.createDataFrame(rows, "wafer_id long, sensor_id int, reading_value double")
    small = {r[0]: r[1] for r in impute.channel_median(df).collect()}
    large = {r[0]: r[1] for r in impute.channel_median(df, in_memory_values=0).collect()}
    assert small == large and small[1] == 1.7e308 and small[3] == 0.0


def test_counted_median_reads_the_table_twice_at_most(spark):
    rng = random.Random(9)
    rows = [(i, i % 40, rng.expovariate(1) ** 9) for i in range(20_000)]
    plain = spark.createDataFrame(rows, "wafer_id long, sensor_id int, reading_value double")
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = plain.mapInArrow(counted, plain.schema)
    spread = impute.value_spread(plain).where("sensor_id < 5")
    spread = spread.cache()
    spread.count()
    found = impute.channel_median(df, spread=spread, in_memory_values=0, single_task_rows=100)
    assert found.count() == 5
    assert len(rows) <= read.value <= 2 * len(rows)


def test_files_are_numbered_in_the_given_or_the_natural_order(spark, tmp_path):
    folder = write_files(
        tmp_path / "f", {f"log-{n}.txt": [f"{n}\n"] for n in (2, 10, 1, 99999, 100000)}
    )

    def numbers(path):
        rows = ordinals.number_rows(ordinals.read_lines(spark, path), "n", path).collect()
        return [r["value"] for r in sorted(rows, key=lambda r: r["n"])]

    assert numbers(folder) == ["1", "2", "10", "99999", "100000"]
    listed = [f"{folder}/log-{n}.txt" for n in (10, 2, 100000)]
    assert numbers(listed) == ["10", "2", "100000"]
    write_files(tmp_path / "g", {"log-1.txt": ["a\n"], "log-01.txt": ["b\n"]})
    with pytest.raises(ValueError, match="no order"):
        numbers(str(tmp_path / "g"))


def test_embedding_equals_hand_computed_tfidf(spark):
    texts = ["Wafer yield by day", "yield, yield and wafer", "no match here", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    encoder = search.fit_encoder(df, dimensions=4096)
    found = {r["id"]: np.array(r["embedding"]) for r in search.embed_text(df, encoder).collect()}
    words = [re.findall(r"\w+", t.lower()) for t in texts]
    slots = [[search.word_slot(w, 4096) for w in ws] for ws in words]
    for i, ws in enumerate(slots):
        vector = np.zeros(4096)
        for slot in ws:
            vector[slot] += math.log((len(texts) + 1) / (sum(slot in s for s in slots) + 1))
        norm = np.linalg.norm(vector)
        assert np.allclose(found[i], vector / norm if norm else vector, atol=1e-6)
    both, same = search.fit_and_embed(df, 4096)
    assert same == encoder
    assert both.exceptAll(search.embed_text(df, encoder)).isEmpty()


def test_rows_without_a_target_are_in_neither_set(spark):
    rows = [(i, None if i < 20 else i % 2) for i in range(100)]
    df = spark.createDataFrame(rows, "wafer_id long, is_fail int")
    counts = {r[0]: r[1] for r in train.stratified_split(df).groupBy("split").count().collect()}
    assert counts == {None: 20, "test": 16, "train": 64}


def test_all_features_are_found_whatever_their_number(spark):
    names = feature_names(1_200)
    df = spark.range(1).select("id", *(F.lit(0.5).alias(n) for n in reversed(names)), F.lit(1).alias("feature_set"))
    assert train.feature_columns(df) == names


def test_gaps_are_filled_with_medians_of_training_rows(spark):
    rows = [(1.0, None, 5.0), (2.0, None, 6.0), (None, None, 7.0), (9.0, None, 8.0)]
    df = spark.createDataFrame(rows, "feature_001 double, feature_002 double, feature_003 double")
    names = train.feature_columns(df)
    fills = train.fill_values(df, names)
    assert fills == {"feature_001": 2.0, "feature_002": 0.0}
    vectors = [list(map(float, r["features"].toArray())) for r in train.assemble(df, names, fills).collect()]
    assert vectors == [[1.0, 0.0, 5.0], [2.0, 0.0, 6.0], [2.0, 0.0, 7.0], [9.0, 0.0, 8.0]]


FOREST = """
import sys
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from waferlens.operators import train
spark = (SparkSession.builder.master(f"local[{sys.argv[1]}]").config("spark.ui.enabled", "false")
    .config("spark.checkpoint.dir", sys.argv[2]).config("spark.sql.shuffle.partitions", sys.argv[1]).getOrCreate())
rows = spark.range(2000).select((F.col("id") % 3 == 0).cast("int").alias("is_fail"),
    *(((F.xxhash64("id", F.lit(i)) % 1000) / 7.0 + F.col("id") % 3 * i).alias(f"feature_{i:03d}") for i in range(1, 6)))
model = train.train_forest(rows.repartition(int(sys.argv[1])), [f"feature_{i:03d}" for i in range(1, 6)], trees=6, depth=5)
print("TREES", hash(model.toDebugString.split("\\n", 1)[1]), model.featureImportances)
"""


def test_the_forest_does_not_depend_on_cores(tmp_path):
    root = str(Path(__file__).resolve().parent.parent)
    env = os.environ | {"PYTHONPATH": root, "PYTHONHASHSEED": "0"}
    said = []
    for cores in ("2", "4"):
        run = subprocess.run(
            [sys.executable, "-c", FOREST, cores, str(tmp_path / cores)],
            env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300,
        )
        said.append(run.stdout[run.stdout.index("TREES") :])
    assert said[0] == said[1]


def test_a_level_of_the_forest_starts_where_the_last_one_ended(spark, monkeypatch):
    rows = spark.range(600).select(
        (F.col("id") % 3 == 0).cast("int").alias("is_fail"),
        *(((F.xxhash64("id", F.lit(i)) % 1000) / 7.0).alias(f"feature_{i:03d}") for i in range(1, 4)),
    )
    fit, before = train.RandomForestClassifier, dict(spark.sparkContext._jsc.getPersistentRDDs())
    grow = lambda: train.train_forest(rows, feature_names(3), trees=4, depth=12)
    kept = grow()
    assert kept.getCacheNodeIds()
    assert max(tree.depth for tree in kept.trees) > 10  # beyond a checkpoint of the kept nodes
    assert set(spark.sparkContext._jsc.getPersistentRDDs()) <= set(before)
    monkeypatch.setattr(train, "RandomForestClassifier", lambda **kw: fit(**kw | {"cacheNodeIds": False}))
    walked = grow()
    assert not walked.getCacheNodeIds()
    trees = lambda model: model.toDebugString.split("\n", 1)[1]
    assert trees(kept) == trees(walked)


def test_a_repeated_key_stays_on_one_side_of_the_split(spark):
    rows = [(7, 1)] * 400 + [(i, i % 2) for i in range(100, 900)]
    df = spark.createDataFrame(rows, "wafer_id long, is_fail int")
    split = train.stratified_split(df)
    sides = split.groupBy("wafer_id").agg(F.countDistinct("split").alias("n"))
    assert sides.agg(F.max("n")).first()[0] == 1
    assert split.count() == len(rows)


def test_external_encoder_hook(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "abc")], "id int, text string")

    def load():
        return lambda texts: [[len(t), 1.0] for t in texts]

    rows = search.embed_with(df, load).orderBy("id").collect()
    assert [r["embedding"] for r in rows] == [[2.0, 1.0], [3.0, 1.0]]


def test_results_do_not_depend_on_partitioning(spark):
    from waferlens.plans import queries

    sf = "/root/testdata/sf0.001"
    names = ["channel_quality", "wafer_features", "daily_yield", "stratified_split", "roc_auc"]
    before = {n: queries.QUERIES[n](spark, sf).collect() for n in names}
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        for n in names:
            after = queries.QUERIES[n](spark, sf).collect()
            assert sorted(map(repr, after)) == sorted(map(repr, before[n]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_plans_shuffle_only_what_they_must(spark):
    from waferlens.plans import queries

    sf = "/root/testdata/sf0.001"
    config = PipelineConfig(max_null_fraction=0.09)
    staged, fills = queries.feature_parts(spark, sf)
    wide = plan(features.wafer_features_wide(queries.raw_matrix(spark, sf), fills, config))
    assert "Exchange" not in wide and "Generate" not in wide
    imputed = plan(impute.median_impute(staged, fills))
    assert "SortMergeJoin" not in imputed and "hashpartitioning" not in imputed
    profile = plan(quality.channel_profile(staged))
    assert profile.count("Exchange") == 1 and "SinglePartition" not in profile
    long = plan(queries.wafer_features(spark, sf))
    assert "SinglePartition" not in long
    # Only the columns a query needs are read.
    docs = plan(queries.evaluation(spark, sf))
    assert "text" not in docs
    # No row is sorted to split or number classes; only thresholds are joined.
    rows = plan(train.stratified_split(queries.table(spark, sf, "labels"), "doc_id", "quality"))
    assert "CartesianProduct" not in rows and "BroadcastNestedLoopJoin" not in rows


def test_no_query_plans_a_cross_join(spark):
    from waferlens.plans import queries

    sf = "/root/testdata/sf0.001"
    for name in ("dq_report", "metrics_record", "ingest_audit", "knn_search", "search_hits"):
        text = plan(queries.QUERIES[name](spark, sf))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name
