"""Label logs and daily KPIs as streams: restarts, late labels, bad lines, time zones."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from waferlens.operators import yields
from waferlens.streaming import labels as label_streams
from waferlens.streaming import yields as yield_streams


def log_line(wafer, label, at):
    return f'{wafer}\t{label} "{at:%d/%m/%Y %H:%M:%S}"'


def write_log(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


@pytest.fixture
def places(tmp_path):
    return tmp_path / "log", str(tmp_path / "table"), str(tmp_path / "checkpoint")


START = dt.datetime(2024, 3, 1, 6)


def test_a_stream_ended_between_files_takes_each_line_once(spark, places):
    folder, path, checkpoint = places
    write_log(folder, "a.log", [log_line(i, 1, START) for i in range(50)])
    write_log(folder, "b.log", [log_line(i, -1, START) for i in range(50, 80)])
    stream = label_streams.label_stream(spark, str(folder), files_per_batch=1)
    done = []

    def fail_on_second(batch, number):
        if number == 1:
            raise RuntimeError("executor lost")
        done.append(batch.count())

    # A query that ends between two files has taken just the first one.
    query = stream.writeStream.foreachBatch(fail_on_second).trigger(availableNow=True)
    with pytest.raises(Exception, match="executor lost"):
        query.option("checkpointLocation", checkpoint + "-other").start().awaitTermination()
    assert done in ([50], [30])
    for _ in range(2):
        label_streams.ingest_labels(spark, str(folder), path, checkpoint, files_per_batch=1).awaitTermination()
    write_log(folder, "c.log", [log_line(i, 1, START) for i in range(80, 100)])
    label_streams.ingest_labels(spark, str(folder), path, checkpoint).awaitTermination()
    table = label_streams.accepted(spark.read.parquet(path))
    assert sorted(r["wafer_id"] for r in table.collect()) == list(range(100))


def test_an_ended_query_goes_on_where_it_was(spark, places):
    folder, path, checkpoint = places
    write_log(folder, "a.log", [log_line(1, 1, START)])
    query = label_streams.ingest_labels(spark, str(folder), path, checkpoint, every="100 milliseconds")
    query.processAllAvailable()
    query.stop()
    write_log(folder, "b.log", [log_line(2, 1, START)])
    query = label_streams.ingest_labels(spark, str(folder), path, checkpoint, every="100 milliseconds")
    query.processAllAvailable()
    query.stop()
    assert sorted(r["wafer_id"] for r in spark.read.parquet(path).collect()) == [1, 2]


def test_bad_lines_are_kept_apart_and_stop_nothing(spark, places):
    folder, path, checkpoint = places
    good = [log_line(7, -1, START), "8\t1 01/03/2024 10:00:00", ' 9 \t  1   "x" ']
    bad = ['x\t1 "t"', '1 "no key"', "3\tfail \"t\"", "4\t", '99999999999999999999\t1 "t"']
    write_log(folder, "a.log", [*good, "", "   ", *bad])
    label_streams.ingest_labels(spark, str(folder), path, checkpoint).awaitTermination()
    table = spark.read.parquet(path)
    rows = {tuple(r) for r in label_streams.accepted(table).collect()}
    assert rows == {(7, -1, "01/03/2024 06:00:00"), (8, 1, "01/03/2024"), (9, 1, "x")}
    assert {r["value"] for r in label_streams.quarantined(table).collect()} == set(bad)
    # The same columns on a batch.
    lines = spark.read.schema(label_streams.LOG_SCHEMA).text(str(folder))
    again = label_streams.keyed_labels(lines)
    assert again.exceptAll(table.select(again.columns)).isEmpty()


def run_yield(spark, folder, path, checkpoint, delay="2 days"):
    read = label_streams.accepted(label_streams.label_stream(spark, str(folder), files_per_batch=1))
    days = yield_streams.daily_yield_stream(yields.stage_labels(read), delay=delay)
    label_streams.append_stream(days, path, checkpoint).awaitTermination()


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kathmandu"])
def test_closed_days_equal_the_batch(spark, places, zone):
    folder, path, checkpoint = places
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        lines = [log_line(i, (-1, 1, 0)[i % 3], START + dt.timedelta(hours=i)) for i in range(240)]
        lines += ['900\t1 "no time"', '901\t1 "19/07/2024 24:00:00"']
        write_log(folder, "a.log", lines)
        run_yield(spark, folder, path, checkpoint)
        staged = yields.stage_labels(
            label_streams.accepted(label_streams.keyed_labels(spark.read.text(str(folder))))
        )
        newest = START + dt.timedelta(hours=239)
        closed = F.date_add("test_date", 1).cast("timestamp_ntz") <= F.lit(newest - dt.timedelta(days=2))
        expected = yields.daily_yield(staged).where(closed).collect()
        assert len(expected) == 8
        assert sorted(spark.read.parquet(path).collect()) == sorted(expected)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_late_labels_are_dropped_and_slow_ones_are_not(spark, places):
    folder, path, checkpoint = places
    day = lambda n, hour=6: START + dt.timedelta(days=n, hours=hour - 6)
    write_log(folder, "a.log", [log_line(i, 1, day(i)) for i in range(5)])
    run_yield(spark, folder, path, checkpoint)
    # The newest label is of day 4, 6:00, so days 0 and 1 are closed, day 2 is open still.
    table = lambda: {r["test_date"].day: r["wafer_count"] for r in spark.read.parquet(path).collect()}
    assert table() == {1: 1, 2: 1}
    late = [log_line(10, -1, day(0)), log_line(11, -1, day(1, 23))]
    write_log(folder, "b.log", [*late, log_line(12, -1, day(2))])
    run_yield(spark, folder, path, checkpoint)
    assert table() == {1: 1, 2: 1}
    write_log(folder, "c.log", [log_line(13, 1, day(30))])
    run_yield(spark, folder, path, checkpoint)
    assert table() == {1: 1, 2: 1, 3: 2, 4: 1, 5: 1}
    assert spark.read.parquet(path).where("day(test_date) = 3").first()["fail_count"] == 1
