"""Column-level helpers: tolerant casts and reproducible hashes."""

from txmill.functions.casts import FIELD_CASTS, to_date, to_float, to_int
from txmill.functions.hashing import (
    SLOTS,
    below_fraction,
    digest,
    fold_of,
    hash32,
    normal,
    slot,
    uniform,
)
from txmill.functions.times import wall_clock_seconds

__all__ = [
    "FIELD_CASTS",
    "SLOTS",
    "below_fraction",
    "digest",
    "fold_of",
    "hash32",
    "normal",
    "slot",
    "to_date",
    "to_float",
    "to_int",
    "uniform",
    "wall_clock_seconds",
]
