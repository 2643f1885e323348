"""Parquet and CSV tables, and tables from a few rows given in the program."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from txmill.sources import versioned


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan. Name the columns before caching, or the cache holds all of them.

    Of a table with versions (see ``versioned``), the current one is read.
    """
    df = versioned.read_version(spark, path) if versioned.is_versioned(spark, path) else spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_parquet(
    df: DataFrame, path: str, *, files: int | None = None, mode: str = "errorifexists"
) -> None:
    """Write Parquet; ``files`` asks for that many output files, at the price of a shuffle.

    Spark's modes, and ``replace``: a new version that readers see once it is whole.
    """
    if mode == "replace":
        versioned.replace(df, path, files=files)
        return
    out = df.repartition(files) if files else df
    out.write.mode(mode).parquet(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """Write CSV files, each with a header line and no index column."""
    df.write.mode(mode).option("header", True).csv(path)


def rows_to_table(spark: SparkSession, rows: Sequence[tuple], columns: Sequence[str]) -> DataFrame:
    """Table of a handful of rows, for smoke runs."""
    return spark.createDataFrame(list(rows), list(columns))
