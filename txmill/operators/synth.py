"""Labelled synthetic transactions, made from row numbers."""

from __future__ import annotations

from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txmill.functions.hashing import SLOTS, digest, normal, slot, uniform
from txmill.functions.permutation import permuted
from txmill.operators.split import SEED

# Size, share of fraud, id format, and how far timestamps go back.
ROWS = 100_000
FRAUD_RATE = 0.05
ID_PREFIX = "tx_"
ID_DIGITS = 8
FIRST_MINUTE = 1
END_MINUTE = 43_200

# Distribution of each column, with its parameters for normal and for fraudulent
# transactions.
DISTRIBUTIONS: dict[str, tuple[str, tuple, tuple]] = {
    "amount": ("lognormal", (5.0, 1.0), (6.0, 2.0)),
    "hour_of_day": ("integer", (24,), (24,)),
    "day_of_week": ("integer", (7,), (7,)),
    "distance_from_home": ("exponential", (30.0,), (100.0,)),
    "distance_from_last_transaction": ("exponential", (20.0,), (100.0,)),
    "ratio_to_median_purchase_price": ("normal", (1.0, 0.5), (3.0, 1.0)),
    "repeat_retailer": ("bernoulli", (0.5,), (0.2,)),
    "used_chip": ("bernoulli", (0.9,), (0.2,)),
    "used_pin_number": ("bernoulli", (0.8,), (0.2,)),
    "online_order": ("bernoulli", (0.4,), (0.8,)),
}

# Order of the columns.
COLUMN_ORDER = (
    "transaction_id",
    "timestamp",
    "amount",
    "hour_of_day",
    "day_of_week",
    "distance_from_home",
    "distance_from_last_transaction",
    "ratio_to_median_purchase_price",
    "repeat_retailer",
    "used_chip",
    "used_pin_number",
    "online_order",
    "fraud",
)

# How many uniform numbers a value takes, its type, and how it follows from them.
SHAPES: dict[str, tuple[int, str, Callable[..., Column]]] = {
    "lognormal": (2, "double", lambda u, v, mu, sigma: F.exp(mu + sigma * normal(u, v))),
    "normal": (2, "double", lambda u, v, mu, sigma: mu + sigma * normal(u, v)),
    "exponential": (1, "double", lambda u, scale: -scale * F.ln(u)),
    "integer": (1, "int", lambda u, count: F.floor(u * count)),
    "bernoulli": (1, "int", lambda u, p: u < p),
}


def format_ids(number: Column) -> Column:
    """``tx_`` and the number in at least 8 digits."""
    digits = number.cast("string")
    width = F.greatest(F.lit(ID_DIGITS), F.length(digits))
    return F.concat(F.lit(ID_PREFIX), F.lpad(digits, width, F.lit("0")))


def minutes_back(anchor: Column, u: Column) -> Column:
    """``anchor`` less a whole number of minutes, from 1 up to but not including 43200."""
    span = F.lit(END_MINUTE - FIRST_MINUTE)
    minutes = F.lit(FIRST_MINUTE) + F.floor(u * span).cast("int")
    return anchor - F.make_dt_interval(mins=minutes)


def reorder_columns(df: DataFrame, columns=COLUMN_ORDER) -> DataFrame:
    return df.select(*columns)


def first_slots() -> dict[str, int]:
    """Number of the first uniform number each column takes; the timestamp takes number 0."""
    used = [1, *[SHAPES[kind][0] for kind, _, _ in DISTRIBUTIONS.values()]]
    return dict(zip(DISTRIBUTIONS, accumulate(used), strict=False))


def _draw(column: str, uniforms: list[Column]) -> Column:
    kind, usual, fraud = DISTRIBUTIONS[column]
    takes, dtype, shape = SHAPES[kind]
    first = first_slots()[column]
    by_class = [
        F.when(F.col("fraud") == F.lit(1), F.lit(f)).otherwise(F.lit(u))
        for u, f in zip(usual, fraud, strict=True)
    ]
    return shape(*uniforms[first : first + takes], *by_class).cast(dtype).alias(column)


def transactions_for(
    rows: DataFrame,
    key: str,
    *,
    count: int,
    anchor: str,
    fraud_rate: float = FRAUD_RATE,
    seed: int = SEED,
    number: str | None = None,
) -> DataFrame:
    """One transaction per row of ``rows``, whose ``key`` holds each of 0..count-1 once.

    ``int(count * (1 - fraud_rate))`` keys, the lowest, are normal and the rest fraudulent. All
    values hang on the key, so any partitioning gives the same table. Ids are numbered by the
    column ``number``, or else by the key.
    """
    normal_rows = int(count * (1 - fraud_rate))
    numbers = 1 + sum(SHAPES[kind][0] for kind, _, _ in DISTRIBUTIONS.values())
    digests = [f"_digest{i}" for i in range(-(-numbers // SLOTS))]
    drawn = rows.select(
        F.col(number or key).alias("_number"),
        (F.col(key) >= F.lit(normal_rows)).cast("int").alias("fraud"),
        *[digest(key, f"row-{seed}-{i}").alias(name) for i, name in enumerate(digests)],
    )
    uniforms = [uniform(slot(F.col(digests[i // SLOTS]), i % SLOTS)) for i in range(numbers)]
    made = drawn.select(
        format_ids(F.col("_number")).alias("transaction_id"),
        minutes_back(F.lit(anchor).cast("timestamp_ntz"), uniforms[0]).alias("timestamp"),
        *[_draw(c, uniforms) for c in DISTRIBUTIONS],
        "fraud",
    )
    return reorder_columns(made)


def synthetic_transactions(
    spark: SparkSession,
    *,
    anchor: str,
    count: int = ROWS,
    fraud_rate: float = FRAUD_RATE,
    seed: int = SEED,
    shuffle: bool = False,
    places: range | None = None,
) -> DataFrame:
    """``count`` transactions whose times lie in the 30 days before ``anchor``.

    ``shuffle`` mixes the two classes: ids follow a permutation of the rows instead of the class.
    ``places`` makes only the rows that another permutation puts there; ranges that share no place
    share no row, so they are exact samples without a look at the other rows. All of it is a
    projection of row numbers: nothing is shuffled, sorted or counted.
    """
    chosen = places if places is not None else range(count)
    rows = spark.range(chosen.start, chosen.stop, chosen.step)
    if places is not None:
        rows = rows.select(permuted(F.col("id"), count, f"sample-{seed}").alias("id"))
    if shuffle:
        rows = rows.withColumn("position", permuted(F.col("id"), count, f"shuffle-{seed}"))
    return transactions_for(
        rows,
        "id",
        count=count,
        anchor=anchor,
        fraud_rate=fraud_rate,
        seed=seed,
        number="position" if shuffle else None,
    )
