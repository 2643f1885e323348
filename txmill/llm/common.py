"""Small helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txmill.sources.scratch import scratch_path

WHITE_SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write to the shared folder and read back: later steps neither recompute nor lose it."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole(text: Column | str) -> Column:
    """The text, with NULL as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def packed(df: DataFrame, name: str = "row") -> DataFrame:
    """All columns in one struct, so that added columns cannot clash with them."""
    return df.select(F.struct(*[df[c] for c in df.columns]).alias(name))


def per_text(function: Callable[[Iterable[str]], pa.Array], returns: str) -> Callable[..., Column]:
    """Arrow function of one text column; ``function`` maps the texts of a batch to an array."""

    def batch(texts: pa.Array) -> pa.Array:
        return function("" if t is None else t for t in texts.to_pylist())

    batch.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(batch, returnType=returns)


def held_out(doc_id: Column | str) -> Column:
    """True for documents that no label is learned from: crc32 of the id as text, modulo 5, is 0."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5 == 0, F.lit(False))
