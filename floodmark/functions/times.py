"""Numbers from timestamps, whatever the session's zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 00:00 on the timestamp's own clock."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz").cast("timestamp")
    return F.unix_micros(ts.cast("timestamp")) - F.unix_micros(origin)


def epoch_millis(ts: Column) -> Column:
    return F.floor(epoch_micros(ts) / 1000).cast("long")
