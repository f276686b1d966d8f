"""Stage boundaries: reliable checkpoints and the shared folder they live in."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


# Paths staged inside each open ``staging`` block.
_staging: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local master without the setting gets a folder of its own; on a
    cluster a machine-local folder would lose data with its machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_SETTING, None) or context.getConf().get(
        CHECKPOINT_SETTING
    )
    current = context.getCheckpointDir()
    if configured:
        if current is None:
            context.setCheckpointDir(configured)
        return configured
    if current is not None:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="waferlens-"))
    return context.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the shared folder and read it back.

    Used where the staged rows are wide or many, so later scans can prune
    columns, which a checkpoint cannot.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    for paths in _staging:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete what lies under a path of the shared folder."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    place.getFileSystem(settings).delete(place, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that were staged inside the block when it ends.

    For work whose results are stored by then; a DataFrame that still reads a
    staged table cannot be used after it.
    """
    paths: list[str] = []
    _staging.append(paths)
    try:
        yield
    finally:
        _staging.remove(paths)
        for path in paths:
            remove_path(spark, path)
