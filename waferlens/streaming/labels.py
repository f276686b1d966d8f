"""Pass/fail logs as a stream: new files are parsed once and appended exactly once.

A line is ``<wafer id><TAB><label> "<timestamp>"``. On a stream no row number
can stand for the wafer, so the log has to name it; what follows the key is
read by the same columns as a batch log. A stream must not end at one bad line,
so lines without an integer key or label are stored beside the others, as they
came, with ``readable`` false.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from waferlens.sources.labels import split_label_lines

KEY_END = "\t"
LOG_SCHEMA = "value string"


def keyed_labels(lines: DataFrame, wafer: str = "wafer_id", line: str = "value") -> DataFrame:
    """(wafer, label, timestamp text, readable, line) of log lines with a key; blank lines go.

    A column expression of the line alone, for batches and streams alike.
    ``line`` is kept where the key or the label is no integer; the other
    columns are then NULL.
    """
    text = F.col(line)
    key = F.substring_index(text, KEY_END, 1).try_cast("long")
    rest = F.substring(text, F.instr(text, KEY_END) + 1, F.length(text))
    keyed = lines.where(F.trim(text) != "").select(
        F.when(F.instr(text, KEY_END) > 0, key).alias("_key"), rest.alias("_rest"), text.alias("_line")
    )
    split = split_label_lines(keyed, "_rest").withColumn(
        "_label", F.col("label_text").try_cast("int")
    )
    readable = F.col("_key").isNotNull() & F.col("_label").isNotNull()
    return split.select(
        F.when(readable, F.col("_key")).alias(wafer),
        F.when(readable, F.col("_label")).alias("pass_fail_raw"),
        F.when(readable, F.col("timestamp_str")).alias("timestamp_str"),
        readable.alias("readable"),
        F.when(~readable, F.col("_line")).alias(line),
    )


def label_stream(
    spark: SparkSession, folder: str, files_per_batch: int | None = None, wafer: str = "wafer_id"
) -> DataFrame:
    """The log files of a folder as a stream, those there and those to come, each once.

    ``files_per_batch`` bounds a batch, so that a long backlog is worked off in steps.
    """
    reader = spark.readStream.schema(LOG_SCHEMA)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return keyed_labels(reader.text(folder), wafer)


def append_stream(
    rows: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Start to append a stream to a Parquet table.

    What the files of each batch are is written down before they become
    visible, and how far the input has been read is kept under ``checkpoint``:
    started again with the same folders after any end, the stream goes on where
    it was, and each input row is in the table once. Without ``every`` it takes
    what is there and ends, else it looks for more at that interval.
    """
    writer = rows.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def ingest_labels(
    spark: SparkSession,
    folder: str,
    path: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Append the label log files of ``folder`` to the table at ``path`` as they come."""
    return append_stream(label_stream(spark, folder, files_per_batch), path, checkpoint, every)


def accepted(table: DataFrame) -> DataFrame:
    """The readable labels, in the columns of a batch log."""
    return table.where("readable").drop("readable", "value")


def quarantined(table: DataFrame) -> DataFrame:
    """The lines that could not be read."""
    return table.where("not readable").select("value")
