"""The text operators bound to the given tables, one query each, with SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from waferlens.llm import (
    bpe,
    decontaminate,
    fingerprint,
    html_text,
    language_id,
    merkle,
    ngram_join,
    packing,
    secret_scan,
    site_quality,
    substring,
    url_filter,
    vector_codes,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by the four rules."""
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.rule_table(spark))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text."""
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every text."""
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text, learned from documents that are not held out."""
    return language_id.language_of_documents(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's evidence, the rate of its section, and whether it stays."""
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    judged = site_quality.judge(docs, labels, with_text=False)
    return judged.select("doc_id", "source", "lang", "p_text", "p_site", "p_reject", "keep")


def op6_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, without its site's templates."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    return decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the size of its shingle set and its near-duplicate component."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the windows that occur elsewhere too."""
    return substring.digest(substring.remove_repeats(table(spark, sf_dir, "documents")))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof against the manifest of all, after some were tampered with."""
    return merkle.verify_documents(table(spark, sf_dir, "documents"))


def op12_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every text's token ids and of the text that they decode to."""
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's code, its error, the error of its label, the codebooks' digest."""
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_url_filter": op1_url_filter,
    "op2_fingerprints": op2_fingerprints,
    "op3_secret_scan": op3_secret_scan,
    "op4_language_id": op4_language_id,
    "op5_quality": op5_quality,
    "op6_page_text": op6_page_text,
    "op7_decontaminate": op7_decontaminate,
    "op8_ngram_join": op8_ngram_join,
    "op9_repeated_passages": op9_repeated_passages,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_byte_pairs": op12_byte_pairs,
    "op13_vector_codes": op13_vector_codes,
}

# Compressed sizes, tokenisers and fitted models have no SQL form; the rest is tested by brute force.
ORACLE_SQL: dict[str, str] = {
    "op1_url_filter": url_filter.SQL,
    "op7_decontaminate": decontaminate.sql(),
    "op8_ngram_join": ngram_join.sql(),
    "op9_repeated_passages": substring.sql(),
    "op11_merkle_manifest": merkle.sql(),
    "op13_vector_codes": vector_codes.sql(),
}
