"""Tolerant parsing: what cannot be read becomes NULL, never an error.

Each parser looks at the type the source already has. A typed column is passed
through untouched, so filters on it can still reach the Parquet scan; only text
goes through the pattern checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Date and time shapes, spellings of truth, the month key.
ISO_DATE = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{2}.*)?\z"
SLASH_DATE = r"^\d{1,2}/\d{1,2}/\d{4}\z"
NAMED_DATE = r"^\d{1,2}-[A-Za-z]{3}-\d{4}\z"
MONTH_KEY = r"^[0-9]{4}-(0[1-9]|1[0-2])\z"
TRUE_WORDS = ("true", "t", "yes", "y", "on", "1")
FALSE_WORDS = ("false", "f", "no", "n", "off", "0")
BILINGUAL_TRUE_WORDS = ("1", "true", "t", "yes", "y", "si", "sí", "s")
BILINGUAL_FALSE_WORDS = ("0", "false", "f", "no", "n")


def text_to_date(text: Column) -> Column:
    """ISO dates (a time of day is dropped), month/day/year, and day-Mon-year."""
    t = F.trim(text)
    return (
        F.when(t.rlike(ISO_DATE), F.substring_index(F.substring_index(t, " ", 1), "T", 1).try_cast("date"))
        .when(t.rlike(SLASH_DATE), F.try_to_date(t, "M/d/yyyy"))
        .when(t.rlike(NAMED_DATE), F.try_to_date(F.initcap(F.lower(t)), "d-MMM-yyyy"))
    )


def text_to_timestamp(text: Column) -> Column:
    """ISO timestamps without zone; a bare date means midnight."""
    t = F.trim(text)
    return F.when(t.rlike(ISO_DATE), t.try_cast("timestamp_ntz"))


def safe_date(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.col(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.col(name).cast("date")
    return text_to_date(F.col(name).cast("string"))


def safe_timestamp(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.col(name).cast("timestamp_ntz")
    return text_to_timestamp(F.col(name).cast("string"))


def safe_boolean(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.BooleanType):
        return F.col(name)
    word = F.lower(F.trim(F.col(name).cast("string")))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def normalize_boolean(col: Column, default: bool | None = False) -> Column:
    """English and Spanish yes/no words; anything else is ``default``."""
    word = F.lower(F.trim(col.cast("string")))
    return (
        F.when(word.isin(*BILINGUAL_TRUE_WORDS), True)
        .when(word.isin(*BILINGUAL_FALSE_WORDS), False)
        .otherwise(F.lit(default).cast("boolean"))
    )


def flag(col: Column) -> Column:
    """1 is true; 0, NULL and any other number are false."""
    return F.coalesce(col == 1, F.lit(False))


def safe_decimal(col: Column, precision: int, scale: int) -> Column:
    """Half-up rounding to ``scale``; unreadable text gives NULL."""
    return col.try_cast(f"decimal({precision},{scale})")


def number_in_text(col: Column, precision: int, scale: int) -> Column:
    """A number wrapped in symbols, such as ``BOB 12.50`` or ``2.5%``."""
    return safe_decimal(F.regexp_replace(col, "[^0-9.-]", ""), precision, scale)


def is_month_key(col: Column) -> Column:
    return col.rlike(MONTH_KEY)


def month_key_to_date(col: Column) -> Column:
    """First day of a ``YYYY-MM`` month."""
    return F.concat(col, F.lit("-01")).try_cast("date")
