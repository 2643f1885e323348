"""Choosing, assembling and scaling feature columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

# The label, and columns that are never features. Identifiers are features.
LABEL = "tx_fraud"
NOT_FEATURES = ("tx_fraud", "tx_fraud_scenario", "tx_datetime")
RAW_VECTOR = "features_raw"
VECTOR = "features"


def feature_columns(schema: StructType, exclude: Sequence[str] = ()) -> list[str]:
    """Feature names by the schema alone: all but the fixed exclusions and text columns.

    Identifiers are kept; name them in ``exclude`` to leave them out.
    """
    return [
        f.name
        for f in schema.fields
        if f.name not in NOT_FEATURES
        and f.name not in exclude
        and not isinstance(f.dataType, StringType)
    ]


def assemble(df: DataFrame, columns: Sequence[str], out: str = RAW_VECTOR) -> DataFrame:
    """Numeric columns as one vector; a NULL among them is an error when the rows are read."""
    return VectorAssembler(inputCols=list(columns), outputCol=out).transform(df)


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace columns by (x - mean) / sample standard deviation; a constant column becomes 0.

    Mean and deviation of all columns come from one aggregate, used as a scalar subquery.
    """
    moments = df.agg(
        F.struct(
            *[F.avg(c).alias(f"mean_{c}") for c in columns],
            *[F.stddev_samp(c).alias(f"std_{c}") for c in columns],
        ).alias("moments")
    ).scalar()

    def scaled(column: str) -> Column:
        mean, std = moments.getField(f"mean_{column}"), moments.getField(f"std_{column}")
        z = F.try_divide(F.col(column) - mean, std)
        return F.when(F.col(column).isNotNull(), F.coalesce(z, F.lit(0.0))).alias(column)

    return df.select(*[scaled(c) if c in columns else F.col(c) for c in df.columns])
