"""Collection nights: days that begin at a local hour."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def night(utc: Column, zone_hours: int = 8, begins: int = 3) -> Column:
    """The day an instant in UTC belongs to, where days begin at `begins` o'clock in a zone `zone_hours` ahead (one without changes of clock)."""
    return F.to_date(utc + F.make_dt_interval(hours=F.lit(zone_hours - begins)))


def published(days: Column, back: Column | int) -> Column:
    """The day `back` published days before the last one (0: the last), null if there are fewer; days: an array."""
    return F.get(F.sort_array(F.array_distinct(days), asc=False), F.lit(back) if isinstance(back, int) else back)


def utc_date(text: Column) -> Column:
    """The date of an instant in text; malformed or out of range: null."""
    return F.to_date(F.try_to_timestamp(text))
