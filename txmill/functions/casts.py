"""Text-to-type casts that give NULL for bad text, whatever the session's ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# An optionally signed decimal number, with the blanks and control characters a cast ignores.
_DECIMAL_NUMBER = (
    r"^[\x00-\x20\x7f]*(?<sign>[+-]?)(?=[\d.])(?<whole>\d*)(?:\.\d*)?[\x00-\x20\x7f]*$"
)


def to_int(text: Column) -> Column:
    """Integer part of a decimal number: ``12.5`` is 12, ``.5`` is 0, ``1e3`` is NULL.

    Plain integers take the cheap cast; the pattern only runs on text that cast refuses.
    """
    whole = F.regexp_replace(text, F.lit(_DECIMAL_NUMBER), F.lit("${sign}0${whole}"))
    return F.coalesce(text.try_cast("int"), whole.try_cast("int"))


def to_float(text: Column) -> Column:
    return text.try_cast("float")


def to_date(text: Column) -> Column:
    """Date part of a date or timestamp text; the time of day is lost."""
    return text.try_cast("date")


FIELD_CASTS = {"int": to_int, "float": to_float, "date": to_date}
