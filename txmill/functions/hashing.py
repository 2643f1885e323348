"""Pseudo-random values that depend on a row's key only, never on its partition.

``rand(seed)`` and ``sample(seed)`` change when the data is laid out differently. MD5 is used
because every SQL engine has it, so the values can be checked outside Spark.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = 1 << 32
_SLOT_HEX = 8
SLOTS = 4


def digest(key: str | Column | Sequence[str], salt: object) -> Column:
    """MD5 of the key columns and a salt, in hex. It has room for four independent numbers."""
    keys = [key] if isinstance(key, str | Column) else list(key)
    columns = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(salt)), *[c.cast("string") for c in columns]))


def slot(hexadecimal: Column, number: int = 0) -> Column:
    """One of the four integers in [0, 2**32) that a digest holds."""
    part = F.substring(hexadecimal, 1 + _SLOT_HEX * number, _SLOT_HEX)
    return F.conv(part, 16, 10).cast("bigint")


def hash32(key: str | Column | Sequence[str], salt: object = 42) -> Column:
    """Integer in [0, 2**32) from the key columns and a salt."""
    return slot(digest(key, salt))


def below_fraction(key: str | Sequence[str], fraction: float, salt: object = 42) -> Column:
    """True for about ``fraction`` of the keys, always for the same ones."""
    return hash32(key, salt) < F.lit(int(fraction * HASH_RANGE))


def fold_of(key: str | Sequence[str], folds: int, salt: object = 42) -> Column:
    """Fold number 0..folds-1, for ``CrossValidator(foldCol=...)``."""
    return (hash32(key, f"fold-{salt}") % F.lit(folds)).cast("int")


def uniform(number: Column) -> Column:
    """Uniform double in (0, 1) from an integer in [0, 2**32)."""
    return (number + F.lit(0.5)) / F.lit(float(HASH_RANGE))


def normal(first: Column, second: Column) -> Column:
    """Standard normal double from two uniform ones (Box-Muller)."""
    return F.sqrt(F.lit(-2.0) * F.ln(first)) * F.cos(F.lit(2.0 * math.pi) * second)
