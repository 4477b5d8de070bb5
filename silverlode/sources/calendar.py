"""The calendar of the gold layer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.functions import dates

# First day and number of days.
FIRST_DAY = dt.date(2015, 1, 1)
DAYS = 7305
LAST_DAY = FIRST_DAY + dt.timedelta(days=DAYS - 1)
YEARS_AHEAD = 2
WEEKEND = (6, 7)


def last_calendar_day(as_of: dt.date | None):
    """Two years from the run, or the end of the calendar if that comes first."""
    return F.least(F.lit(LAST_DAY), F.add_months(dates.day(as_of), 12 * YEARS_AHEAD))


def dim_date(spark: SparkSession, as_of: dt.date | None = None) -> DataFrame:
    """One row per day with its names, numbers and month bounds."""
    day = F.col("calendar_date")
    iso_day = F.extract(F.lit("DAYOFWEEK_ISO"), day)
    return (
        spark.range(DAYS)
        .select(F.date_add(F.lit(FIRST_DAY), F.col("id").cast("int")).alias("calendar_date"))
        .filter(day <= last_calendar_day(as_of))
        .select(
            dates.date_key(day).alias("date_key"),
            "calendar_date",
            F.year(day).alias("year_number"),
            F.quarter(day).alias("quarter_number"),
            F.month(day).alias("month_number"),
            dates.month_key(day).alias("year_month"),
            F.monthname(day).alias("month_name"),
            F.weekofyear(day).alias("iso_week_number"),
            F.dayofmonth(day).alias("day_of_month"),
            iso_day.alias("iso_day_of_week"),
            F.dayname(day).alias("day_name"),
            iso_day.isin(*WEEKEND).alias("is_weekend"),
            dates.month_start(day).alias("month_start"),
            F.last_day(day).alias("month_end"),
        )
    )
