"""Train/test splits, samples and a shuffled order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txmill.functions.hashing import below_fraction, hash32
from txmill.operators.chunks import positions

# Share of the training part, and the seed.
TRAIN_FRACTION = 0.8
SEED = 42

# The hash range is cut into 2**12 cells, and each of them again.
_CELL_BITS = 12


def with_split(
    df: DataFrame,
    key: str | Sequence[str],
    fraction: float = TRAIN_FRACTION,
    seed: int = SEED,
    out: str = "split",
) -> DataFrame:
    """Add ``train`` or ``test`` by a hash of the key.

    A projection without a shuffle. Unlike ``randomSplit`` it gives a row the same part however
    the data is laid out and whichever other rows there are.
    """
    part = F.when(below_fraction(key, fraction, seed), F.lit("train")).otherwise(F.lit("test"))
    return df.withColumn(out, part)


def hash_split(
    df: DataFrame, key: str | Sequence[str], fraction: float = TRAIN_FRACTION, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Train and test part as two filters over the same scan."""
    inside = below_fraction(key, fraction, seed)
    return df.filter(inside), df.filter(~inside)


def random_split(
    df: DataFrame, fraction: float = TRAIN_FRACTION, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Spark's ``randomSplit``; the parts depend on the physical layout of ``df``."""
    train, test = df.randomSplit([fraction, 1.0 - fraction], seed=seed)
    return train, test


def _boundary(counts: DataFrame) -> Column:
    """From cell, rows, size: the cell in which row number ``size`` lies, and its place there."""
    up_to = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        counts.withColumn("upto", F.sum("rows").over(up_to))
        .withColumn("before", F.col("upto") - F.col("rows"))
        .filter((F.col("before") < F.col("size")) & (F.col("size") <= F.col("upto")))
        .select(F.struct("cell", (F.col("size") - F.col("before")).alias("wanted")).alias("at"))
        .scalar()
    )


def exact_sample_condition(
    df: DataFrame, key: str, fraction: float = TRAIN_FRACTION, seed: int = SEED
) -> Column:
    """Condition that holds for exactly ``round(fraction * rows)`` rows of ``df``.

    Rows are taken in hash order of the key. If the key repeats, its rows stay together and the
    sample is the smallest one that reaches the size. The last key taken comes from scalar
    subqueries: rows are counted per cell of the hash range, then per cell of the cell that holds
    the boundary, and only the inner boundary cell is ordered, one row per key: a 2**24th of them.
    The sample itself is a filter; no row of it is shuffled.
    """
    hashed = df.select(F.col(key).alias("key"), hash32(key, f"sample-{seed}").alias("hash"))
    coarse, fine = F.shiftright("hash", 32 - _CELL_BITS), F.shiftright("hash", 32 - 2 * _CELL_BITS)
    everything = Window.orderBy("cell").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    totals = hashed.groupBy(coarse.alias("cell")).agg(F.count("*").alias("rows"))
    size = F.bround(F.sum("rows").over(everything) * F.lit(fraction)).cast("bigint")
    outer = _boundary(totals.withColumn("size", size))
    inner = _boundary(
        hashed.filter(coarse == outer.getField("cell"))
        .groupBy(fine.alias("cell"))
        .agg(F.count("*").alias("rows"))
        .withColumn("size", outer.getField("wanted"))
    )
    inside = hashed.filter(fine == inner.getField("cell"))
    in_order = Window.orderBy("hash", "key").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    last = (
        inside.groupBy("hash", "key")
        .agg(F.count("*").alias("rows"))
        .withColumn("upto", F.sum("rows").over(in_order))
        .filter(F.col("upto") >= inner.getField("wanted"))
        .agg(F.min(F.struct("hash", "key")).alias("last"))
    )
    place = F.struct(hash32(key, f"sample-{seed}").alias("hash"), F.col(key).alias("key"))
    return F.coalesce(place <= last.scalar(), F.lit(False))


def sample_and_rest(
    df: DataFrame,
    key: str,
    fraction: float = TRAIN_FRACTION,
    seed: int = SEED,
    *,
    exact: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """A sample and all rows outside it.

    By default each key is in with probability ``fraction``: one cheap predicate and its
    negation. ``exact`` hits the sample size exactly, for two more passes over the key column.
    """
    inside = (
        exact_sample_condition(df, key, fraction, seed)
        if exact
        else below_fraction(key, fraction, seed)
    )
    return df.filter(inside), df.filter(~inside)


def shuffled_position(
    df: DataFrame, key: str, seed: int = SEED, out: str = "position"
) -> DataFrame:
    """Add each row's place, from 0, in hash order of a unique key.

    The hash range is cut into 2**12 cells and each of them again, so a task places a 2**24th of
    the rows, and adds up at most 2**12 totals.
    """
    hashed = df.withColumn("_hash", hash32(key, f"shuffle-{seed}"))
    celled = hashed.withColumns(
        {
            "_outer": F.shiftright("_hash", 32 - _CELL_BITS),
            "_inner": F.shiftright("_hash", 32 - 2 * _CELL_BITS),
        }
    )
    placed = positions(celled, [], "_outer", "_inner", ["_hash", key], out)
    return placed.withColumn(out, F.col(out) - F.lit(1)).drop("_hash", "_outer", "_inner")
