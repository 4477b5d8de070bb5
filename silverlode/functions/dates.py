"""Calendar arithmetic by boundary, month keys and integer date keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(as_of: dt.date | None) -> Column:
    """The clock of a run: a fixed day, or today."""
    return F.current_date() if as_of is None else F.lit(as_of)


def months_between(start: Column, end: Column) -> Column:
    """Month boundaries crossed: 31 January to 1 February is one."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed between two zone-less timestamps."""
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", start), F.date_trunc("minute", end))


def month_start(col: Column) -> Column:
    return F.trunc(col, "month")


def month_key(col: Column) -> Column:
    """``YYYY-MM``. Cut from the ISO text of the date, so no time zone is involved."""
    return F.substring(col.cast("date").cast("string"), 1, 7)


def date_key(col: Column) -> Column:
    """``YYYYMMDD`` as an integer."""
    return F.year(col) * 10000 + F.month(col) * 100 + F.dayofmonth(col)
