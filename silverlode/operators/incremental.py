"""Reading only what is newer than a target."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.operators.latest import EXTRACTED_AT

WATERMARK = "source_extracted_at"


def high_water_mark(target: DataFrame, column: str = WATERMARK) -> int | None:
    """Newest timestamp in the target, in microseconds; None for an empty target.

    This runs a job for one number, so that the slice compares with a constant:
    constants reach the Parquet statistics, subqueries do not.
    """
    return target.agg(F.max(F.unix_micros(F.col(column).cast("timestamp")))).first()[0]


def _after(column: Column, mark: int | None, lookback: dt.timedelta) -> Column:
    if mark is None:
        return column.isNotNull()
    return column > F.timestamp_micros(F.lit(mark - lookback // dt.timedelta(microseconds=1)))


def incremental_slice(
    df: DataFrame, mark: int | None, column: str = WATERMARK, lookback: dt.timedelta = dt.timedelta(0)
) -> DataFrame:
    """Rows strictly newer than the mark.

    Rows that arrive late with an older or equal timestamp are passed over for
    good; ``lookback`` reads that much again, which the merge absorbs.
    """
    return df.filter(_after(F.col(column), mark, lookback))


def changed_versions(raw: DataFrame, mark: int | None, lookback: dt.timedelta = dt.timedelta(0)) -> DataFrame:
    """Raw rows that can still decide a record newer than the mark.

    Picking the newest version among these gives the same record as picking
    among all and slicing afterwards, at the cost of the new rows only. Rows
    without a timestamp sort first and are kept, since they can hide a record.
    """
    if mark is None:
        return raw
    column = F.col(EXTRACTED_AT)
    return raw.filter(column.isNull() | _after(column, mark, lookback))
