"""Documents for catalog search: table and column docs, heading chunks, their union."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waferlens.functions.columns import strip_blanks

# Ids, texts and metadata of the documents, as printf patterns.
MODEL_ID, MODEL_TEXT = "model::%s", "Model %s: %s"
COLUMN_ID, COLUMN_TEXT = "column::%s.%s", "Column %s in model %s: %s"
GLOSSARY_ID = "glossary::%s"
HEADING_DELIMITER = "\n## "

DOCUMENT_SCHEMA = "id string, text string, metadata map<string,string>"


def _metadata(**entries: Column | str) -> Column:
    pairs = []
    for key, value in entries.items():
        pairs += [F.lit(key), F.lit(value) if isinstance(value, str) else value]
    return F.create_map(*pairs)


def _described(description: str) -> Column:
    return strip_blanks(F.coalesce(F.col(description), F.lit("")))


def model_docs(models: DataFrame, name: str = "name", description: str = "description") -> DataFrame:
    """One document per (name, description) row."""
    return models.select(
        F.format_string(MODEL_ID, name).alias("id"),
        F.format_string(MODEL_TEXT, name, _described(description)).alias("text"),
        _metadata(type="model", name=F.col(name)).alias("metadata"),
    )


def column_docs(
    columns: DataFrame,
    model: str = "model",
    column: str = "column",
    description: str = "description",
) -> DataFrame:
    """One document per (model, column, description) row."""
    return columns.select(
        F.format_string(COLUMN_ID, model, column).alias("id"),
        F.format_string(COLUMN_TEXT, column, model, _described(description)).alias("text"),
        _metadata(type="column", model=F.col(model), column=F.col(column)).alias("metadata"),
    )


def catalog_docs(catalog: DataFrame) -> DataFrame:
    """Documents of a nested catalog: rows of (name, description, columns[name, description])."""
    columns = catalog.select(
        F.col("name").alias("model"), F.explode("columns").alias("_column")
    ).select(
        "model",
        F.col("_column.name").alias("column"),
        F.col("_column.description").alias("description"),
    )
    return model_docs(catalog).unionByName(column_docs(columns))


def split_chunks(text: Column, delimiter: str = HEADING_DELIMITER) -> Column:
    """Stripped, non-blank pieces of a text; blanks go before anything is numbered."""
    pieces = F.transform(F.split(text, re.escape(delimiter)), strip_blanks)
    return F.filter(pieces, lambda piece: piece != "")


def doc_chunks(
    texts: DataFrame,
    text: str = "text",
    key: str | None = None,
    delimiter: str = HEADING_DELIMITER,
) -> DataFrame:
    """One document per chunk; its title is its first line.

    Chunks are numbered from 0 within their text. With ``key`` the number is
    prefixed by the text's key, so that many texts keep distinct ids.
    """
    chunks = texts.select(
        *([F.col(key).cast("string").alias("_key")] if key else []),
        F.posexplode(split_chunks(F.col(text), delimiter)).alias("_number", "_chunk"),
    )
    number = F.col("_number").cast("string")
    label = F.concat_ws("::", "_key", number) if key else number
    return chunks.select(
        F.format_string(GLOSSARY_ID, label).alias("id"),
        F.col("_chunk").alias("text"),
        _metadata(
            type="glossary", title=F.substring_index("_chunk", "\n", 1)
        ).alias("metadata"),
    )


def read_chunks(spark: SparkSession, path: str, delimiter: str = HEADING_DELIMITER) -> DataFrame:
    """Chunks of one text file; a missing file has none."""
    try:
        return doc_chunks(
            spark.read.text(path, wholetext=True), text="value", delimiter=delimiter
        )
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], DOCUMENT_SCHEMA)


def tables_catalog(spark: SparkSession, tables: list[str]) -> DataFrame:
    """Nested catalog of published tables, described by their own column comments."""
    rows = []
    for table in tables:
        columns = [(c.name, c.description) for c in spark.catalog.listColumns(table)]
        rows.append((table, spark.catalog.getTable(table).description, columns))
    return spark.createDataFrame(
        rows,
        "name string, description string, "
        "columns array<struct<name: string, description: string>>",
    )


def catalog_corpus(*documents: DataFrame) -> DataFrame:
    """All documents together, duplicates kept; an empty corpus is an error at ``index``."""
    corpus, *others = documents
    for other in others:
        corpus = corpus.unionByName(other)
    return corpus


def index_manifest(corpus: DataFrame, collection: str, embedding_model: str) -> DataFrame:
    return corpus.agg(F.count(F.lit(1)).alias("document_count")).select(
        F.lit(collection).alias("collection"),
        "document_count",
        F.lit(embedding_model).alias("embedding_model"),
    )
