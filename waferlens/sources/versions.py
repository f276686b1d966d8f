"""Tables that are published together: all of a run become visible by one switch.

A table ``name`` is a view over ``name_versions``, whose rows are partitioned by
the version they were written for. Which version readers see is said by one
table, ``publications``; its newest row counts. So a run writes its rows where
nobody looks, checks them, and adds one row, in one file: before it every
reader has the old tables, after it the new ones, and no reader a mixture. The
version is looked up when a query starts, and only its partition is read.

Whatever a run that ended half-way has left behind is no version that was ever
published: the next run removes it. Older versions are removed after a switch,
but for the last ones, whose readers may still be busy. One run at a time may
publish to a collection.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waferlens.shared import remove_path
from waferlens.sources.tables import create_schema, quoted

VERSION = "_version"
PUBLICATIONS = "publications"
PUBLICATION = (
    "collection string, sequence long, version string,"
    " tables array<struct<name: string, columns: array<string>>>"
)
# Published versions that stay: the present one and the one before it.
KEPT = 2


def stored_name(layer: str, name: str) -> str:
    return f"{layer}.{name}_versions"


def publications(spark: SparkSession, layer: str, collection: str) -> list:
    """What was published, newest first: as many rows as there were runs."""
    if not spark.catalog.tableExists(f"{layer}.{PUBLICATIONS}"):
        return []
    rows = spark.table(f"{layer}.{PUBLICATIONS}").where(F.col("collection") == collection)
    return rows.orderBy(F.desc("sequence"), F.desc("version")).collect()


def current_version(spark: SparkSession, layer: str, collection: str) -> str | None:
    found = publications(spark, layer, collection)
    return found[0]["version"] if found else None


def begin(
    spark: SparkSession, layer: str, collection: str, names: Sequence[str], root: str | None = None
) -> str:
    """The name of a new version, after putting right what an ended run has left."""
    create_schema(spark, layer, root)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {layer}.{PUBLICATIONS}"
        f" ({PUBLICATION}, published_at timestamp) USING parquet"
    )
    recover(spark, layer, collection, names)
    return uuid.uuid4().hex[:12]


def add(
    df: DataFrame,
    layer: str,
    name: str,
    version: str,
    root: str | None = None,
    comments: Mapping[str, str] | None = None,
    description: str | None = None,
) -> DataFrame:
    """Write the rows of a version, unseen by readers, and return them as stored.

    Columns may be added or left out from one version to the next; another
    type needs another name, and is refused before anything is written.
    """
    spark, table, names = df.sparkSession, stored_name(layer, name), df.columns
    for column, comment in (comments or {}).items():
        df = df.withMetadata(column, {"comment": comment})
    if spark.catalog.tableExists(table):
        df = _fitted(df, spark, table)
    else:
        # Made before anything is written, so that an ended run leaves no files without a table.
        columns = ", ".join([*map(_column, df.schema), f"{VERSION} STRING"])
        place = f"LOCATION {quoted(f'{root}/{layer}/{name}_versions')}" if root else ""
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({VERSION}) {place}"
        )
    if description:
        spark.sql(f"COMMENT ON TABLE {table} IS {quoted(description)}")
    df.withColumn(VERSION, F.lit(version)).write.insertInto(table)
    return read_version(spark, layer, name, version, names)


def _fitted(df: DataFrame, spark: SparkSession, table: str) -> DataFrame:
    """``df`` in the columns of a stored table, which gets those that are new to it."""
    stored = {f.name: f for f in spark.table(table).schema if f.name != VERSION}
    for field in df.schema:
        known = stored.get(field.name)
        if known is not None and known.dataType != field.dataType:
            raise ValueError(
                f"{table}.{field.name} is {known.dataType.simpleString()}, not {field.dataType.simpleString()}"
            )
    fresh = [f for f in df.schema if f.name not in stored]
    if fresh:
        added = ", ".join(_column(f) for f in fresh)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")
    missing = [f for name, f in stored.items() if name not in df.columns]
    whole = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    return whole.select(*stored, *(f.name for f in fresh))


def _named(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _column(field: T.StructField) -> str:
    comment = field.metadata.get("comment")
    return f"{_named(field.name)} {field.dataType.simpleString()}" + (
        f" COMMENT {quoted(comment)}" if comment else ""
    )


def read_version(
    spark: SparkSession, layer: str, name: str, version: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """A table as it was written for one version, published or not."""
    table = spark.table(stored_name(layer, name)).where(F.col(VERSION) == version)
    return table.select(*map(_named, columns)) if columns else table.drop(VERSION)


def switch(
    spark: SparkSession, layer: str, collection: str, version: str, columns: Mapping[str, Sequence[str]]
) -> None:
    """Make the tables of ``columns`` (name to columns) those of ``version``.

    The one step that readers can see; views only follow it where a table is
    new or its columns changed.
    """
    found = publications(spark, layer, collection)
    tables = [(name, list(names)) for name, names in columns.items()]
    row = [(collection, (found[0]["sequence"] if found else 0) + 1, version, tables)]
    entry = spark.createDataFrame(row, PUBLICATION).withColumn("published_at", F.current_timestamp())
    entry.coalesce(1).write.insertInto(f"{layer}.{PUBLICATIONS}")
    _show(spark, layer, collection)


def _show(spark: SparkSession, layer: str, collection: str) -> None:
    """Views over the tables of the newest publication, where they are not there yet."""
    found = publications(spark, layer, collection)
    for name, columns in found[0]["tables"] if found else []:
        view, table = f"{layer}.{name}", stored_name(layer, name)
        if spark.catalog.tableExists(view):
            if spark.catalog.getTable(view).tableType != "VIEW":
                spark.sql(f"DROP TABLE {view}")  # from before tables had versions
            elif spark.table(view).columns == list(columns):
                continue
        comments = {c.name: c.description for c in spark.catalog.listColumns(table)}
        listed = ", ".join(
            _named(c) + (f" COMMENT {quoted(comments[c])}" if comments.get(c) else "") for c in columns
        )
        description = spark.catalog.getTable(table).description
        said = f"COMMENT {quoted(description)}" if description else ""
        spark.sql(
            f"""CREATE OR REPLACE VIEW {view} ({listed}) {said} AS
            SELECT {", ".join(map(_named, columns))} FROM {table}
            WHERE {VERSION} = (SELECT max_by(version, struct(sequence, version))
                               FROM {layer}.{PUBLICATIONS} WHERE collection = {quoted(collection)})"""
        )


def clean_up(
    spark: SparkSession, layer: str, collection: str, names: Sequence[str], kept: int = KEPT
) -> None:
    """Remove all rows that no publication but the last ``kept`` ones has, files included."""
    stay = {row["version"] for row in publications(spark, layer, collection)[:kept]}
    for name in names:
        table = stored_name(layer, name)
        if not spark.catalog.tableExists(table):
            continue
        place = _place(spark, table)
        for version in _stored_versions(spark, table, place) - stay:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({VERSION} = {quoted(version)})")
            remove_path(spark, f"{place}/{VERSION}={version}")
        spark.catalog.refreshTable(table)


def _place(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def _stored_versions(spark: SparkSession, table: str, place: str) -> set[str]:
    """Versions with files, those that the catalog has not heard of included."""
    known = {row[0].partition("=")[2] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return known | {n.partition("=")[2] for n in names if n.startswith(f"{VERSION}=")}


def recover(spark: SparkSession, layer: str, collection: str, names: Sequence[str]) -> None:
    """Put right what a run has left that ended between any two steps.

    Its rows go if they were not published; if they were, views that it did
    not come to are made.
    """
    clean_up(spark, layer, collection, names)
    _show(spark, layer, collection)
