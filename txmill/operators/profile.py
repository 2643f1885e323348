"""Counts and reports about a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_counts(columns: Sequence[str]) -> list[Column]:
    """Aggregates that count the NULLs of each column."""
    return [F.count_if(F.col(c).isNull()).alias(c) for c in columns]


def null_profile(df: DataFrame, *, only_present: bool = True) -> DataFrame:
    """NULLs per column as ``(column, nulls)`` rows, all columns in one pass."""
    counts = df.agg(*null_counts(df.columns))
    profile = counts.unpivot([], df.columns, "column", "nulls")
    return profile.filter(F.col("nulls") > 0) if only_present else profile


def group_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of ``column``, for example per part of a split."""
    return df.groupBy(column).agg(F.count("*").alias("rows"))


def split_profile(df: DataFrame, split: str) -> DataFrame:
    """Row count and NULLs of every other column, per part of a split, in one pass."""
    others = [c for c in df.columns if c != split]
    return df.groupBy(split).agg(F.count("*").alias("rows"), *null_counts(others))


def label_summary(df: DataFrame, label: str) -> DataFrame:
    """Rows, positives and the share of positives in percent."""
    return df.agg(
        F.count("*").alias("rows"),
        F.sum(label).cast("bigint").alias("positives"),
        (F.avg(label) * F.lit(100.0)).alias("positive_pct"),
    )


def first_rows(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in a stated order (a top-n, not a full sort)."""
    return df.orderBy(*order_by).limit(n)


def schema_report(df: DataFrame) -> list[tuple[int, str, str]]:
    """Position, name and type of each column; reads no data."""
    return [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes)]


def missing_columns(columns: Sequence[str]) -> Column:
    """Names of the columns that are NULL in a row, as an array; empty in most rows."""
    found = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])
    return F.array_compact(found)
