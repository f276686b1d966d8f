"""Declarative data-quality checks; each finds failing rows, a suite counts them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DataQualityError(RuntimeError):
    """At least one check of a suite found failing rows."""


@dataclass(frozen=True)
class Check:
    """``kind`` is not_null, unique or accepted_values; ``values`` serves the last."""

    kind: str
    table: str
    column: str
    values: tuple = ()

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.table}.{self.column}"


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows whose column is NULL."""
    return df.where(F.col(column).isNull())


def not_null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, failures) for many columns from a single scan."""
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "failures")


def unique(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """(columns, n_records) of values that occur more than once; NULLs are ignored."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    return (
        df.dropna(subset=columns)
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where("n_records > 1")
    )


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """(value, n_records) of values outside the accepted ones; NULLs are ignored."""
    return (
        df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def _key_and_nulls(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row: repeated values of ``key`` and NULLs per column, from one scan and shuffle."""
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"_null_{c}") for c in columns],
    )
    repeated = F.col(key).isNotNull() & (F.col("_rows") > 1)
    return per_key.agg(
        F.count(F.when(repeated, 1)).alias("_repeated"),
        *[F.coalesce(F.sum(f"_null_{c}"), F.lit(0)).alias(f"_null_{c}") for c in columns],
    )


def _table_suite(df: DataFrame, checks: Sequence[Check]) -> list[DataFrame]:
    """(test, failures) tables covering all checks of one table."""
    nulls = [check for check in checks if check.kind == "not_null"]
    keys = [check for check in checks if check.kind == "unique"]
    values = [check for check in checks if check.kind == "accepted_values"]
    parts = []
    if keys:
        found = _key_and_nulls(df, keys[0].column, [check.column for check in nulls])
        results = [(keys[0].name, "_repeated")]
        results += [(check.name, f"_null_{check.column}") for check in nulls]
        rows = [
            F.struct(F.lit(name).alias("test"), F.col(column).alias("failures"))
            for name, column in results
        ]
        parts.append(found.select(F.inline(F.array(*rows))))
    elif nulls:
        counted = not_null_counts(df, [check.column for check in nulls])
        prefix = f"not_null:{nulls[0].table}."
        parts.append(
            counted.select(F.concat(F.lit(prefix), "column_name").alias("test"), "failures")
        )
    failing = [(check, unique(df, check.column)) for check in keys[1:]]
    failing += [(check, accepted_values(df, check.column, check.values)) for check in values]
    parts += [
        rows.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(check.name).alias("test"), "failures"
        )
        for check, rows in failing
    ]
    return parts


def run_suite(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """(test, failures) per check.

    Failures are failing rows of not_null, repeated values of unique, and
    distinct unexpected values of accepted_values. The key check and all
    not_null checks of a table come from the same scan.
    """
    parts = []
    for table, df in tables.items():
        parts += _table_suite(df, [check for check in checks if check.table == table])
    return reduce(DataFrame.unionByName, parts)


def require_clean(report: DataFrame) -> None:
    """Raise with the failing tests, if any; a report has one row per test."""
    failing = report.where("failures > 0").orderBy("test").collect()
    if failing:
        listed = ", ".join(f"{row['test']} ({row['failures']})" for row in failing)
        raise DataQualityError(f"{len(failing)} data-quality checks failed: {listed}")
