"""Date ranges, months and epoch values.

Ranges compare the bare column with a literal, so that they reach the scan.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_micros(micros: str) -> Column:
    """Epoch microseconds (number or text) to a timestamp; unreadable text gives NULL.

    Text may have a point or an exponent, as in ``1593878946592107.0``; a fraction is cut off.
    """
    value = F.col(micros)
    whole = value.try_cast("decimal(38,6)").try_cast("bigint")
    scientific = F.when(value.cast("string").rlike("[eE]"), value.try_cast("double").try_cast("bigint"))
    return F.timestamp_micros(F.coalesce(value.try_cast("bigint"), scientific, whole))


def in_years(moment: str, first: int, last: int) -> Column:
    """From 1 January of ``first`` up to, not including, 1 January after ``last``."""
    start = F.lit(datetime.date(first, 1, 1))
    end = F.lit(datetime.date(last + 1, 1, 1))
    return (F.col(moment) >= start) & (F.col(moment) < end)


def in_year(moment: str, year: int) -> Column:
    return in_years(moment, year, year)


def month_of(moment: str) -> Column:
    return F.date_format(moment, "yyyy-MM")


def seconds_between(start: str, end: str) -> Column:
    """Whole epoch seconds of ``end`` minus those of ``start``."""
    return _epoch(end) - _epoch(start)


def _epoch(moment: str) -> Column:
    return F.unix_seconds(F.col(moment).cast("timestamp"))
