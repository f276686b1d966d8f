"""From raw documents to packed training sequences, stage by stage.

Each stage takes what its predecessor kept, written as Parquet and read again,
and returns the same columns; the last returns the places of all pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from waferlens.llm import decontaminate, ngram_join, packing, secret_scan, site_quality
from waferlens.llm.common import fresh_name
from waferlens.shared import stage_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    names = [fresh_name(docs.columns, f"_{n}") for n in ("p_text", "p_site", "p_reject", "keep")]
    judged = site_quality.judge(docs, labels, names=tuple(names))
    return judged.where(names[-1]).select(docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return ngram_join.keep_first(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a window of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    names = tuple(fresh_name(docs.columns, f"_{n}") for n in ("n_words", "hits", "items"))
    flagged = decontaminate.flag_contaminated(docs, benchmark, names=names)
    return flagged.where(f"size({names[1]}) = 0").select(docs.columns)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of every secret."""
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of all documents that are left."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_good),
    ("ngram_jaccard_join", keep_one_of_each),
    ("benchmark_decontamination", keep_uncontaminated),
    ("secret_scans", hide_secrets),
    ("best_fit_packing", pack),
]

# A fitted classifier, compressed sizes and a tokeniser have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
