"""Period windows and day buckets, as column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(day: Column | str | dt.date) -> Column:
    return day if isinstance(day, Column) else F.lit(day).cast("date")


def period_start(day: Column | str | dt.date, period: str = "daily", floor: str | dt.date | None = None) -> Column:
    """First day of the reporting window that ends at ``day``.

    ``weekly`` reaches six days back but not before ``floor`` (a launch day);
    ``monthly`` starts at the first of the month; anything else is the day itself.
    """
    day = as_date(day)
    if period == "weekly":
        start = F.date_sub(day, 6)
        return start if floor is None else F.greatest(start, as_date(floor))
    if period == "monthly":
        return F.trunc(day, "MM").cast("date")
    return day


def week_bucket(day: Column | str, anchor: str | dt.date, width: int = 7) -> Column:
    """First day of the ``width``-day bucket, counted from ``anchor``, that holds ``day``."""
    day = F.col(day) if isinstance(day, str) else day
    anchor = as_date(anchor)
    steps = F.floor(F.datediff(day, anchor) / F.lit(width)).cast("int")
    return F.date_add(anchor, steps * F.lit(width))
