"""Time arithmetic on ``timestamp_ntz`` that never consults the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_SQL = "timestamp_ntz'1970-01-01 00:00:00'"


def epoch_seconds(time: Column) -> Column:
    """Seconds since 1970 with six exact decimals."""
    gap = (time - F.expr(_EPOCH_SQL)).cast("interval second")
    return gap.cast("decimal(20,6)")


def from_epoch_micros(micros: Column) -> Column:
    return F.expr(_EPOCH_SQL) + micros * F.expr("INTERVAL '0.000001' SECOND")


def from_epoch_seconds(seconds: Column) -> Column:
    """Inverse of :func:`epoch_seconds`; digits below a microsecond are cut."""
    return from_epoch_micros(F.floor(seconds * 1000000).cast("bigint"))


def from_iso_text(text: Column) -> Column:
    """ISO-8601 text to UTC; an offset in the text is honoured, null if unreadable."""
    return from_epoch_micros(F.unix_micros(text.try_cast("timestamp")))


def minutes(count: Column | int) -> Column:
    # integer times interval is a long multiplication; make_dt_interval works in decimals
    return (F.lit(count) if isinstance(count, int) else count) * F.expr("INTERVAL '1' MINUTE")


def hours(count: Column) -> Column:
    return count * F.expr("INTERVAL '1' HOUR")


def day_start(time: Column) -> Column:
    return time.cast("date").cast("timestamp_ntz")


def hour_start(time: Column) -> Column:
    return day_start(time) + hours(F.hour(time))
