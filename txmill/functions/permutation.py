"""A keyed permutation of the numbers 0..count-1, computed for each number on its own.

Numbers are written as two digits, ``place = left * low + right``, and in each round one digit is
moved by a hash of the other: a Feistel network over a grid of ``high * low`` places. The grid is as
small as two nearly equal digits allow, so it has less than one row more than ``count`` places. A
number that lands there is sent round again, until it lands inside: the outside places on its way
are all different, and that makes it a permutation of the inner ones.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from txmill.functions.hashing import hash32

ROUNDS = 6
#: Times a number is sent round again. Fewer than one in sqrt(count) lands outside each time, so more
#: are needed with a chance of count * sqrt(count) ** -17 at most; that is refused, never passed over.
WALKS = 16


def grid(count: int) -> tuple[int, int]:
    """Number of values of each digit; their product is at least ``count``, by less than the second."""
    low = math.isqrt(max(count, 1) - 1) + 1
    return -(-max(count, 1) // low), low


def permuted(place: Column, count: int, seed: object) -> Column:
    """Where ``place``, a whole number from 0 to ``count`` - 1, goes; no shuffle and no second pass."""
    high, low = grid(count)

    def once(number: Column) -> Column:
        left, right = F.floor(number / F.lit(low)), number % F.lit(low)
        for i in range(ROUNDS):
            salt = f"permute-{seed}-{i}"
            if i % 2 == 0:
                left = (left + hash32(right, salt)) % F.lit(high)
            else:
                right = (right + hash32(left, salt)) % F.lit(low)
        return left * F.lit(low) + right

    first = once(place.cast("bigint"))
    walks = min(high * low - count, WALKS)
    if not walks:
        return first
    last = F.aggregate(
        F.sequence(F.lit(1), F.lit(walks)),
        first,
        lambda at, _: F.when(at < F.lit(count), at).otherwise(once(at)),
    )
    lost = F.raise_error(F.lit(f"no place below {count} after {walks} rounds")).cast("bigint")
    return F.when(last < F.lit(count), last).otherwise(lost)
