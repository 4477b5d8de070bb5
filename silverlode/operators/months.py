"""Rows per month of an interval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.functions import dates


def months_covered(df: DataFrame, start: Column, end: Column, earliest: Column, latest: Column) -> DataFrame:
    """One row per month touched by ``[start, end]``, within the given bounds.

    Each row makes its own months, so the work is the size of the result; a
    join with a list of months on a range would try every pair.
    """
    first = F.greatest(dates.month_start(start), dates.month_start(earliest))
    last = F.least(dates.month_start(end), dates.month_start(latest))
    months = F.sequence(F.col("__first"), F.col("__last"), F.expr("interval 1 month"))
    return (
        df.select("*", first.alias("__first"), last.alias("__last"))
        # Bounds that cross make a descending sequence, which is an error; the
        # condition stays inside the expression, where no reordering can split them.
        .select("*", F.explode(F.when(F.col("__first") <= F.col("__last"), months)).alias("month_start"))
        .drop("__first", "__last")
    )
