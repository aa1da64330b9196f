"""Time expressions over zone-less timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NTZ = "timestamp_ntz"


def truncated(unit: str, col: Column | str) -> Column:
    """Start of the month, day, hour, ... as a zone-less timestamp."""
    return F.date_trunc(unit, _c(col)).cast(NTZ)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    return F.unix_timestamp(_c(end).cast("timestamp")) - F.unix_timestamp(_c(start).cast("timestamp"))


def minutes_elapsed(start: Column | str, end: Column | str) -> Column:
    """Whole minutes that have passed; a started minute does not count."""
    return F.timestamp_diff("MINUTE", _c(start), _c(end))


def minutes_crossed(start: Column | str, end: Column | str) -> Column:
    """Number of minute boundaries between the two instants."""
    first, last = F.date_trunc("minute", _c(start)), F.date_trunc("minute", _c(end))
    return F.timestamp_diff("MINUTE", first, last)


def from_epoch_millis(col: Column | str) -> Column:
    return F.timestamp_millis(_c(col))


def epoch_millis(col: Column | str) -> Column:
    return F.unix_millis(_c(col).cast("timestamp"))


def parsed(col: Column | str, pattern: str) -> Column:
    """Text to timestamp; null when the text does not follow the pattern."""
    return F.try_to_timestamp(_c(col), F.lit(pattern))


def on_date(col: Column | str, day: str) -> Column:
    """``col`` falls on ``day``, as a half-open range so the scan can skip row groups."""
    start = F.lit(day).cast(NTZ)
    return (_c(col) >= start) & (_c(col) < start + F.expr("INTERVAL 1 DAY"))


def within(col: Column | str, start: str, end: str) -> Column:
    """Half-open interval [start, end)."""
    return (_c(col) >= F.lit(start).cast(NTZ)) & (_c(col) < F.lit(end).cast(NTZ))


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
