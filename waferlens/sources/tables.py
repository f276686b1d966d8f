"""Layered tables: full-refresh writes, guarded reads, load audit, JSON records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The layers, each a schema of that very name.
BRONZE, STAGING, INTERMEDIATE, MARTS = "bronze", "staging", "intermediate", "marts"

# Standard error of channels counted by a sketch.
CHANNEL_COUNT_ERROR = 0.01


def require_inputs(spark: SparkSession, *paths: str) -> None:
    """Fail before any work when an input file is missing."""
    for path in paths:
        try:
            spark.read.text(path)
        except AnalysisException as failed:
            if failed.getCondition() != "PATH_NOT_FOUND":
                raise
            raise FileNotFoundError(f"input not found: {path}") from failed


def write_table(
    df: DataFrame,
    layer: str,
    name: str,
    root: str | None = None,
    comments: Mapping[str, str] | None = None,
    description: str | None = None,
) -> DataFrame:
    """Replace ``layer.name`` by ``df`` and return it as read back from storage.

    With ``root`` the files go to ``<root>/<layer>/<name>``, else to the warehouse.
    ``comments`` describe columns, ``description`` the table.
    """
    spark = df.sparkSession
    create_schema(spark, layer, root)
    for column, comment in (comments or {}).items():
        df = df.withMetadata(column, {"comment": comment})
    writer = df.write.mode("overwrite").format("parquet")
    if root:
        writer = writer.option("path", f"{root}/{layer}/{name}")
    writer.saveAsTable(f"{layer}.{name}")
    if description:
        spark.sql(f"COMMENT ON TABLE {layer}.{name} IS {quoted(description)}")
    return spark.table(f"{layer}.{name}")


def create_schema(spark: SparkSession, layer: str, root: str | None = None) -> None:
    location = f" LOCATION {quoted(f'{root}/{layer}')}" if root else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {layer}{location}")


def quoted(text: str) -> str:
    """A text as SQL writes it."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def write_view(spark: SparkSession, layer: str, name: str, query: str, description: str, root: str | None = None) -> DataFrame:
    """Replace the view ``layer.name`` by an SQL query over tables."""
    create_schema(spark, layer, root)
    spark.sql(
        f"CREATE OR REPLACE VIEW {layer}.{name} COMMENT {quoted(description)} AS {query}"
    )
    return spark.table(f"{layer}.{name}")


def read_table(spark: SparkSession, name: str, order_by: str | None = None) -> DataFrame:
    """A published table by name; missing or empty tables are errors."""
    if not spark.catalog.tableExists(name):
        raise RuntimeError(f"{name} does not exist; run the pipeline first")
    table = spark.table(name)
    if table.isEmpty():
        raise RuntimeError(f"{name} is empty; run the pipeline first")
    return table.orderBy(order_by) if order_by else table


def ingest_audit(
    wide: DataFrame, long: DataFrame, sensor: str = "sensor_id", exact: bool = True
) -> DataFrame:
    """Wafer, reading and channel counts in one row; each table is scanned once.

    Unless ``exact``, channels are counted by a sketch, whose size is fixed.
    """
    if exact:
        sensors = F.countDistinct(sensor)
    else:
        sensors = F.approx_count_distinct(sensor, CHANNEL_COUNT_ERROR)
    per_table = wide.agg(F.count(F.lit(1)).alias("wafer_count")).unionByName(
        long.agg(
            F.count(F.lit(1)).alias("reading_count"),
            sensors.alias("sensor_count"),
        ),
        allowMissingColumns=True,
    )
    return per_table.agg(*[F.max(c).alias(c) for c in per_table.columns])


def write_json(record: DataFrame, path: str) -> None:
    """A one-row record as a single JSON document."""
    record.coalesce(1).write.mode("overwrite").json(path)
