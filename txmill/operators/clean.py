"""From raw text lines to typed, complete transactions with one row per id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txmill.functions.casts import FIELD_CASTS
from txmill.sources.text import COMMENT

# Fixed values of the record format: field types by position, and the key's name in the header.
FIELD_TYPES = ("int", "date", "int", "int", "float", "int", "int", "int", "int")
FIELD_SEPARATOR = ","
RAW_KEY = "tranaction_id"
KEY = "transaction_id"
AMOUNT = "tx_amount"
FIELD_NAMES = (
    KEY,
    "tx_datetime",
    "customer_id",
    "terminal_id",
    AMOUNT,
    "tx_time_seconds",
    "tx_time_days",
    "tx_fraud",
    "tx_fraud_scenario",
)

#: Files of another layout than the first whose columns are sent to all tasks; beyond, a join.
BROADCAST_FILES = 10_000
_SALTS = 64


def drop_comments(lines: DataFrame) -> DataFrame:
    """Drop every line that starts with ``#``, wherever it stands."""
    return lines.filter(~F.col("value").startswith(COMMENT))


def _fields(lines: DataFrame, names: Sequence[str], casts: Sequence) -> DataFrame:
    # inline() keeps the record in one Generate step. In a plain projection the optimizer copies
    # the split and the casts into the filter for missing values and runs all of them twice.
    located = "positions" in lines.columns
    parts = lines.select(
        F.split("value", FIELD_SEPARATOR).alias("parts"), *(["positions"] if located else [])
    )
    record = F.struct(
        *[
            cast(F.get("parts", F.get("positions", F.lit(i)) if located else F.lit(i))).alias(name)
            for i, (name, cast) in enumerate(zip(names, casts, strict=True))
        ]
    )
    return parts.select(F.inline(F.array(record)))


def split_fields(lines: DataFrame, names: Sequence[str]) -> DataFrame:
    """Name the leading fields of each line. Extra fields are ignored, missing ones are NULL."""
    return _fields(lines, names, [lambda text: text] * len(names))


def cast_fields(df: DataFrame, types: Sequence[str] = FIELD_TYPES) -> DataFrame:
    """Cast text columns by position; text that does not fit its type becomes NULL."""
    typed = zip(df.columns, types, strict=True)
    return df.select(*[FIELD_CASTS[t](F.col(name)).alias(name) for name, t in typed])


def typed_fields(
    lines: DataFrame, names: Sequence[str], types: Sequence[str] = FIELD_TYPES
) -> DataFrame:
    """``split_fields`` and ``cast_fields`` in one step; a column ``positions`` says where fields stand."""
    return _fields(lines, names, [FIELD_CASTS[t] for t in types])


def proper_names(names: Sequence[str]) -> list[str]:
    """Column names with the key's proper one."""
    return [KEY if n == RAW_KEY else n for n in names]


def types_of(names: Sequence[str]) -> list[str]:
    """Types of columns: by name if all are known, else by position."""
    known = dict(zip(FIELD_NAMES, FIELD_TYPES))
    proper = proper_names(names)
    return [known[n] for n in proper] if set(proper) == set(known) else list(FIELD_TYPES)


def located_fields(
    lines: DataFrame, headers: DataFrame, names: Sequence[str], broadcast: bool = True
) -> DataFrame:
    """Add ``positions``, the place of each of ``names`` in the lines of a file, to (value, file) rows.

    ``headers`` has file and names of the files with a header; files without one have the columns of
    ``names``, and so need no row in the join. Without ``broadcast`` the lines are joined in salted
    groups, so a file with many of them is spread over tasks.
    """
    usual = F.array(*[F.lit(n) for n in proper_names(names)])
    theirs = F.transform("names", lambda n: F.when(n == F.lit(RAW_KEY), F.lit(KEY)).otherwise(n))
    others = headers.select("file", theirs.alias("names")).filter(F.col("names") != usual)
    places = F.transform(usual, lambda n: F.array_position(F.col("names"), n).cast("int") - 1)
    others = others.select("file", places.alias("positions"))
    lines = lines.select("value", "file")
    if broadcast:
        joined = lines.join(F.broadcast(others), "file", "left")
    else:
        salted = others.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
        salt = F.pmod(F.xxhash64("value"), F.lit(_SALTS)).cast("int")
        joined = lines.withColumn("salt", salt).join(salted, ["file", "salt"], "left")
    default = F.array(*[F.lit(i) for i in range(len(names))])
    return joined.select("value", F.coalesce("positions", default).alias("positions"))


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows with a NULL or NaN in any column."""
    return df.na.drop("any")


def rename_key(df: DataFrame) -> DataFrame:
    """Give the key its proper name; does nothing if it already has it."""
    return df.withColumnRenamed(RAW_KEY, KEY)


def keep_one_per_key(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Of the rows with the same key, keep the smallest by the other columns in their order.

    An aggregate, not a window: each map task passes on one row per key, so a key that holds a
    large share of the rows costs no more than any other, and no group is ever held in memory.
    """
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.distinct()
    smallest = df.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_row"))
    return smallest.select(
        *[F.col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns]
    )


def complete_transactions(lines: DataFrame, names: Sequence[str]) -> DataFrame:
    """Typed, complete transactions from raw lines and their column names; ids may repeat.

    All columns are found by name, wherever they stand; if the header has unknown names, types go by
    position, and only the id and the amount are found by name. Lines with ``positions`` (see
    ``located_fields``) have their fields there.
    """
    for name in (AMOUNT, KEY):
        if name not in proper_names(names):
            raise ValueError(f"the header names no column {name!r}: {', '.join(names)}")
    typed = typed_fields(drop_comments(lines), names, types_of(names))
    complete = rename_key(drop_incomplete(typed))
    return complete.withColumn(AMOUNT, F.col(AMOUNT).cast("float"))


def clean_transactions(lines: DataFrame, names: Sequence[str]) -> DataFrame:
    """``complete_transactions``, one per id."""
    return keep_one_per_key(complete_transactions(lines, names), KEY)
