"""Dates and times: F5-F9, F18.

Instants are TIMESTAMP, local wall clocks are TIMESTAMP_NTZ.  The session runs in UTC
(`touchtrail.configure`), so a cast between the two never moves a value.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..constants import LOCAL_ZONE


def instant(text: Column, strict: bool = True) -> Column:
    """text to instant, UTC unless the text names an offset.

    Garbage fails the job as in a CAST; ``strict=False`` gives NULL for it instead.
    """
    return F.to_timestamp(text) if strict else F.try_to_timestamp(text)


def wall_clock(moment: Column, zone: str = LOCAL_ZONE, source_zone: str = "UTC") -> Column:
    """local wall clock of a moment; the zone's daylight-saving rules apply."""
    clock = moment.cast("timestamp_ntz")
    if zone == source_zone:
        return clock
    return F.convert_timezone(F.lit(source_zone), F.lit(zone), clock)


def wall_clock_from_text(text: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """text that already is local time; no conversion."""
    return F.to_timestamp_ntz(text, F.lit(pattern))


def local_date(value: Column, zone: str = "UTC", pattern: str | None = None) -> Column:
    """Date of a moment in ``zone``, or of a text in ``pattern``."""
    if pattern is not None:
        return F.to_date(value, pattern)
    return wall_clock(value, zone).cast("date")


def days_between(later: Column, earlier: Column) -> Column:
    """whole days from ``earlier`` to ``later``."""
    return F.datediff(later, earlier)
