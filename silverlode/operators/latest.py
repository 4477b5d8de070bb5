"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverlode.functions.keys import row_fingerprint

EXTRACTED_AT = "_airbyte_extracted_at"
GENERATION = "_airbyte_generation_id"
RANK = "__rank"
# A column that marks rows of which each is the newest version of its record already.
NEWEST = "__newest"


def latest_per_key(
    df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column], total: bool = False
) -> DataFrame:
    """Keep the first row of each key in the given order.

    The filter on the rank lets Spark keep one row per key and task before the
    shuffle, so a key that owns a third of the table arrives as a handful of
    rows. Unless the order is ``total`` already, ties are settled by a
    fingerprint of the row: the same row wins however the input is split and
    after any task is run again.
    """
    order = list(order) if total else [*order, row_fingerprint(df.columns)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.select("*", rank.alias(RANK)).filter(F.col(RANK) == 1).drop(RANK)


def newest_first() -> list[Column]:
    return [F.col(EXTRACTED_AT).desc_nulls_first(), F.col(GENERATION).desc_nulls_first()]


def latest_version(raw: DataFrame, *ids: str) -> DataFrame:
    """Newest extracted version of each record; ids that differ in padding are one."""
    if NEWEST in raw.columns:
        return raw.drop(NEWEST)
    return latest_per_key(raw, [F.trim(F.col(i)) for i in ids], newest_first())
