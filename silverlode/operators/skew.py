"""Joins of large rows to one row per key, some keys of which may be hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SECOND = "__second_key"


def join_apart(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """The join on ``key``, on an exchange of both sides that it shares with no other step.

    Adaptive execution splits a hot key only between two exchanges, and not where a
    neighbouring join uses their partitioning as well. A digest of the key as a
    second key changes no result, but no other step is partitioned by both. ``right``
    should be narrow, as it is exchanged once more. A null key meets nothing.
    """
    second = F.xxhash64(key).alias(SECOND)
    return left.select("*", second).join(right.select("*", second), [key, SECOND], how).drop(SECOND)
