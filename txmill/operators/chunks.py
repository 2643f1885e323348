"""Running totals over long ordered groups without one task per group.

A window over one key puts the whole key into one task. Here an ordered group is cut into chunks,
the window runs inside a chunk, and what earlier chunks add up to comes from one row per chunk.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


_SMALLEST_NORMAL = 2.0**-1022
_SMALLEST = 5e-324
_FRACTION = 1 << 52


def ordered_bits(score: Column) -> Column:
    """Order-preserving image of a double in the whole numbers: equal scores, and only those, share one.

    It is the number's own 64-bit pattern, with the sign carried over, put together from exponent and
    fraction by exact arithmetic. Both zeros are 0; NaN comes last. Cells that follow from its leading
    bits need no pass over the data, and however close scores lie, further bits tell them apart.
    """
    size = F.abs(score)
    guess = F.greatest(F.lit(-1022), F.least(F.lit(1023), F.floor(F.log2(size)))).cast("int")
    power = F.pow(F.lit(2.0), guess)
    exponent = guess + F.when(size < power, F.lit(-1)).when(size / power >= F.lit(2.0), F.lit(1)).otherwise(F.lit(0))
    fraction = (size / F.pow(F.lit(2.0), exponent) - F.lit(1.0)) * F.lit(float(_FRACTION))
    normal = (exponent + F.lit(1023)).cast("bigint") * F.lit(_FRACTION) + fraction.cast("bigint")
    bits = (
        F.when(size == F.lit(0.0), F.lit(0))
        .when(size == F.lit(math.inf), F.lit(2047 * _FRACTION))
        .when(size < F.lit(_SMALLEST_NORMAL), (size / F.lit(_SMALLEST)).cast("bigint"))
        .otherwise(normal)
    )
    signed = F.when(score < F.lit(0.0), -bits).otherwise(bits)
    return F.when(F.isnan(score), F.lit(2048 * _FRACTION - 1)).otherwise(signed)


def running(
    df: DataFrame,
    keys: Sequence[str],
    chunk: str,
    order: Sequence[str],
    value: Column,
    combine: Callable[[str], Column],
    out: str,
    *,
    inclusive: bool,
) -> DataFrame:
    """Add ``out``: ``value`` combined over the rows before (and with ``inclusive`` up to) each row.

    Rows are ordered by ``chunk`` and inside it by ``order``; ``combine`` is ``F.sum`` or ``F.max``.
    What all earlier chunks of a key add up to enters its chunk as one more row, ahead of the
    others. So the rows are shuffled once, by key and chunk, and nothing is joined or broadcast.
    Without keys the chunk totals form one group: the caller must bound the number of chunks.
    """
    rows = df.withColumns({"_value": value, "_row": F.lit(1)})
    earlier = (
        Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        rows.groupBy(*keys, chunk)
        .agg(combine("_value").alias("_total"))
        .select(
            *keys,
            chunk,
            combine("_total").over(earlier).alias("_value"),
            F.lit(0).alias("_row"),
        )
    )
    end = Window.currentRow if inclusive else -1
    in_chunk = (
        Window.partitionBy(*keys, chunk)
        .orderBy("_row", *order)
        .rowsBetween(Window.unboundedPreceding, end)
    )
    return (
        rows.unionByName(carried, allowMissingColumns=True)
        .withColumn(out, combine("_value").over(in_chunk))
        .filter(F.col("_row") == F.lit(1))
        .drop("_value", "_row")
    )


def positions(
    df: DataFrame, keys: Sequence[str], outer: str, inner: str, order: Sequence[str], out: str
) -> DataFrame:
    """Add ``out``, the place 1, 2, ... of each row of a key, by ``outer``, ``inner``, ``order``.

    Places are counted inside an inner chunk; inner chunks are added up inside their outer one, and
    outer ones inside the key. So no task sees more than one inner chunk, the inner chunks of one
    outer chunk, or the outer chunks of one key. The caller's chunks decide how much that is.
    """
    placed = running(
        df, [*keys, outer], inner, order, F.lit(1), F.sum, "_inside", inclusive=True
    )
    earlier = (
        Window.partitionBy(*keys).orderBy(outer).rowsBetween(Window.unboundedPreceding, -1)
    )
    whole = (
        df.groupBy(*keys, outer)
        .agg(F.count("*").alias("_rows"))
        .select(
            F.struct(*keys, outer).alias("_chunk"),
            F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        )
    )
    # Structs compare NULL fields as equal.
    joined = placed.join(whole, F.struct(*keys, outer) == F.col("_chunk"))
    return joined.withColumn(out, F.col("_before") + F.col("_inside")).drop(
        "_inside", "_before", "_chunk"
    )
