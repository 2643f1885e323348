"""Metrics of scored rows as aggregates, exact at any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txmill.operators.chunks import ordered_bits


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per (label, prediction)."""
    return (
        df.select(
            F.col(label).cast("double").alias("label"),
            F.col(prediction).cast("double").alias("prediction"),
        )
        .groupBy("label", "prediction")
        .agg(F.count("*").alias("rows"))
    )


def class_scores(table: DataFrame) -> DataFrame:
    """Support, precision, recall and F1 of every class, from a confusion table."""
    sides = table.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("label").alias("class"),
                    F.col("rows").alias("actual"),
                    F.lit(0).cast("bigint").alias("predicted"),
                    F.when(F.col("label") == F.col("prediction"), F.col("rows"))
                    .otherwise(F.lit(0))
                    .alias("hits"),
                ),
                F.struct(
                    F.col("prediction").alias("class"),
                    F.lit(0).cast("bigint").alias("actual"),
                    F.col("rows").alias("predicted"),
                    F.lit(0).cast("bigint").alias("hits"),
                ),
            )
        )
    )
    per_class = sides.groupBy("class").agg(
        F.sum("actual").alias("actual"),
        F.sum("predicted").alias("predicted"),
        F.sum("hits").alias("hits"),
    )
    none = F.lit(0.0)
    return per_class.select(
        "class",
        "actual",
        "predicted",
        "hits",
        F.coalesce(F.try_divide("hits", "predicted"), none).alias("precision"),
        F.coalesce(F.try_divide("hits", "actual"), none).alias("recall"),
        F.coalesce(
            F.try_divide(F.lit(2.0) * F.col("hits"), F.col("actual") + F.col("predicted")), none
        ).alias("f1"),
    )


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of rows whose prediction equals the label; a missing label or prediction is wrong."""
    hit = (F.col(label).cast("double") == F.col(prediction).cast("double")).cast("int")
    return df.agg(F.avg(F.coalesce(hit, F.lit(0))).alias("accuracy"))


def classification_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", positive: float = 1.0
) -> DataFrame:
    """Accuracy, F1 weighted by class size, and F1 of the positive class, in one pass."""
    scores = class_scores(confusion(df, label, prediction))
    rows = F.sum("actual")
    return scores.agg(
        F.try_divide(F.sum("hits"), rows).alias("accuracy"),
        F.try_divide(F.sum(F.col("f1") * F.col("actual")), rows).alias("f1"),
        F.coalesce(
            F.max(F.when(F.col("class") == F.lit(positive), F.col("f1"))), F.lit(0.0)
        ).alias("f1_positive"),
    )


#: Bits of a score's image below which cells of each level begin; the last level has 2**12 cells.
_CELL_SHIFTS = (14, 28, 42, 52)


def area_under_roc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact area under the ROC curve as one row; NULL unless both classes occur.

    Rows with the same score are added up first. Distinct scores are then ranked inside cells of
    their 64-bit image, one group of bits after the other, and the negatives of lower cells are added
    from one row per cell. A window holds at most 2**14 rows, whatever the scores are: even if all
    are within a hair of 1. One pass over the input. Rows without score or label do not count.
    """
    rows = df.select(
        (F.col(score).cast("double") + F.lit(0.0)).alias("score"),  # turns -0.0 into 0.0
        (F.col(label) == F.lit(1)).alias("positive"),
    ).filter(F.col("score").isNotNull() & F.col("positive").isNotNull())
    ties = (
        rows.groupBy("score")
        .agg(F.count_if("positive").alias("pos"), F.count_if(~F.col("positive")).alias("neg"))
        .withColumn("bits", ordered_bits(F.col("score")))
    )

    def before(window) -> Column:
        found = F.sum("neg").over(window.rowsBetween(Window.unboundedPreceding, -1))
        return F.coalesce(found, F.lit(0))

    def twice(count: Column) -> Column:
        # Twice the pairs ranked right (a tie counts one). Whole numbers, so the order of adding
        # up cannot change the result; decimals, because pairs outgrow a bigint.
        return F.col("pos").cast("decimal(18,0)") * count.cast("decimal(19,0)")

    def added(frame: DataFrame, below: Column, *keys: str) -> DataFrame:
        pairs = F.col("pairs") + twice(F.lit(2) * F.col("below"))
        return (
            frame.withColumn("below", below)
            .groupBy(*keys)
            .agg(
                F.sum("pos").alias("pos"),
                F.sum("neg").alias("neg"),
                F.sum(pairs).cast("decimal(38,0)").alias("pairs"),
            )
        )

    # One row per cell, and in the end one in all.
    cells = ties.withColumn("pairs", twice(F.col("neg")))
    for shift in _CELL_SHIFTS:
        outer = F.shiftright("bits", shift)
        window = Window.partitionBy("outer").orderBy("bits")
        cells = added(cells.withColumn("outer", outer), before(window), "outer")
        cells = cells.withColumn("bits", F.shiftleft("outer", shift)).drop("outer")
    whole = added(cells, before(Window.orderBy("bits")))
    return whole.select(
        F.try_divide(
            F.col("pairs").cast("double"),
            F.lit(2.0) * F.col("pos").cast("double") * F.col("neg").cast("double"),
        ).alias("auc")
    )
