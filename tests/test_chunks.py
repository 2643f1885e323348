import itertools
import math
import struct

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from txmill.operators.chunks import ordered_bits, positions, running


@pytest.fixture(scope="module")
def history(spark):
    """One key holds a third of the rows, one key is NULL, values repeat."""
    return spark.range(900).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 7 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 20))
        .alias("k"),
        F.col("id"),
        F.when(F.col("id") % 11 != 0, F.pmod(F.hash("id"), F.lit(50))).alias("v"),
    )


@pytest.mark.parametrize(
    ("width", "combine", "inclusive"),
    list(itertools.product([1, 10, 10_000], [F.sum, F.max], [True, False])),
)
def test_running_equals_a_plain_window(history, width, combine, inclusive):
    chunked = history.withColumn("c", F.floor(F.col("id") / F.lit(width)))
    ours = running(chunked, ["k"], "c", ["id"], F.col("v"), combine, "r", inclusive=inclusive)
    frame = Window.partitionBy("k").orderBy("id").rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1
    )
    plain = history.withColumn("r", combine("v").over(frame))
    assert ours.columns == ["k", "id", "v", "c", "r"]
    assert sorted(map(str, ours.drop("c").collect())) == sorted(map(str, plain.collect()))


def test_rows_are_shuffled_once_and_never_joined(history):
    chunked = history.withColumn("c", F.floor(F.col("id") / F.lit(10)))
    plan = (
        running(chunked, ["k"], "c", ["id"], F.col("v"), F.max, "r", inclusive=False)
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    assert "Join" not in plan
    assert "hashpartitioning(k" in plan and "SinglePartition" not in plan


def bits_of(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return [r[0] for r in df.select(ordered_bits(F.col("x") + F.lit(0.0))).collect()]


def pattern(value):
    """The number's own 64-bit pattern, with the sign carried over."""
    size = struct.unpack("<q", struct.pack("<d", abs(value)))[0]
    return -size if value < 0 else size


SPECIAL = [
    0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, -(2.0**-1022), 2.0**-1022 - 5e-324, 1.7976931348623157e308,
    math.inf, -math.inf, 0.5, math.nextafter(0.5, 0), math.nextafter(0.5, 1), 1.0, math.nextafter(1.0, 0),
    math.nextafter(1.0, 2), 3.0, -2.0, 1e300, -1e300, *(2.0**k for k in range(-1074, 1024, 7)),
    *(math.nextafter(2.0**k, 0) for k in range(-1000, 1024, 9)),
]


def test_the_image_is_the_numbers_pattern(spark):
    rng = np.random.default_rng(0)
    random = [*rng.normal(size=2000), *np.exp(rng.normal(size=2000) * 100), *(1 - rng.random(2000) * 1e-12)]
    values = [*SPECIAL, *map(float, random)]
    assert bits_of(spark, values) == [pattern(v) for v in values]


def test_nan_comes_last_and_nothing_is_nothing(spark):
    nan, infinite = bits_of(spark, [float("nan"), float("inf")])
    assert nan > infinite
    assert bits_of(spark, [None]) == [None] and bits_of(spark, []) == []


def test_positions_count_over_two_levels(spark):
    df = spark.range(500).select(
        F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("k"),
        (F.col("id") % 7).alias("o"),
        F.when(F.col("id") % 11 > 0, F.col("id") % 11).alias("i"),
        "id",
    )
    rows = positions(df, ["k"], "o", "i", ["id"], "n").collect()
    assert len(rows) == 500
    for key in {r["k"] for r in rows}:
        own = sorted((r for r in rows if r["k"] == key), key=lambda r: (r["o"], r["i"] or -1, r["id"]))
        assert [r["n"] for r in own] == list(range(1, len(own) + 1))
