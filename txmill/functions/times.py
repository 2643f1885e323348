"""Times as numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wall_clock_seconds(ts: Column, epoch: str = "1970-01-01") -> Column:
    """Whole seconds from the start of ``epoch`` to what the clock of a zone-less time shows."""
    since = ts.cast("timestamp_ntz") - F.lit(epoch).cast("timestamp_ntz")
    return since.cast("interval second").cast("bigint")
