"""Text files whose column names stand in a ``#`` line of the data itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the file format: "# name | name | ...".
COMMENT = "#"
HEADER_PREFIX_LENGTH = 2
HEADER_SEPARATOR = " | "


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line of every file the glob matches, in a column ``value``."""
    return spark.read.text(path)


def read_file_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the ``file`` they stand in and where its part begins, ``block``."""
    return spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def find_header(lines: DataFrame) -> str:
    """First ``#`` line. Spark reads as few partitions as it needs to meet one."""
    row = lines.filter(F.col("value").startswith(COMMENT)).first()
    if row is None:
        raise ValueError(f"no header: no line of the input starts with {COMMENT!r}")
    return row["value"]


def header_columns(header: str, required: int) -> list[str]:
    """Column names of a header line; more names than ``required`` are ignored."""
    names = [n.strip() for n in header[HEADER_PREFIX_LENGTH:].split(HEADER_SEPARATOR)]
    if len(names) < required:
        raise ValueError(f"header names {len(names)} columns, {required} are needed: {header!r}")
    return names[:required]


def file_headers(lines: DataFrame, required: int) -> DataFrame:
    """file and names: the columns of each file by its own first header, one row per file with one.

    A ``#`` line that names fewer than ``required`` columns is a remark, not a header.
    """
    value = F.col("value")
    text = F.substring(value, HEADER_PREFIX_LENGTH + 1, (1 << 31) - 1)
    names = F.transform(F.split(text, r" \| "), lambda n: F.regexp_replace(n, r"(?U)^\s+|\s+$", ""))
    headers = lines.filter(value.startswith(COMMENT)).select(
        "file", F.struct("block", F.monotonically_increasing_id().alias("line")).alias("place"), names.alias("names")
    )
    first = headers.filter(F.size("names") >= required).groupBy("file").agg(F.min_by("names", "place").alias("names"))
    return first.select("file", F.slice("names", 1, required).alias("names"))
