"""Time helpers: wire timestamps and bar buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TRUNC_UNITS = {"1 minute": "minute", "1 hour": "hour", "1 second": "second", "1 day": "day"}


def parse_event_ts(col: str | Column) -> Column:
    """ISO-8601 text (with offset) -> timestamp; NULL instead of an error."""
    return F.try_to_timestamp(F.col(col) if isinstance(col, str) else col)


def bar_start(col: str | Column, width: str = "1 minute") -> Column:
    """Start of the tumbling bucket holding ``col`` (UTC session)."""
    c = F.col(col) if isinstance(col, str) else col
    unit = _TRUNC_UNITS.get(width)
    if unit:
        return F.date_trunc(unit, c)
    return F.window(c, width)["start"]
