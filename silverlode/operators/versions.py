"""The newest version of each record, kept as a table and merged with the raw rows that arrive.

Picking the newest of all versions is the same as keeping the winner so far and letting new
versions contest it, in whatever order they arrive. So silver needs no pass over the history:
the winners are stored, still raw, and cleaning them is a projection.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.functions.keys import row_fingerprint, surrogate_key
from silverlode.operators.latest import NEWEST, latest_per_key, latest_version, newest_first
from silverlode.operators.merge import BUCKET, MONTH, MergeTable, read_table, rows_of_keys, table_exists, upsert
from silverlode.operators.storage import path_exists, write_and_read

KEY = "version_key"
DAY = "version_day"
LINK = "version_link"
_STORED = "__stored"
# Folder of the stored rows that a load contests; a first load has none.
_HELD = "held"


@dataclass(frozen=True)
class VersionTable:
    """Winners of one source. ``link`` is a further id that is searched for (the invoice of a payment)."""

    path: str
    ids: tuple[str, ...]
    link: str | None = None

    @property
    def rows(self) -> MergeTable:
        return MergeTable(self.path, KEY, DAY, also_searched=(LINK,) if self.link else ())


def version_key(ids: Sequence[str]) -> Column:
    trimmed = [F.trim(F.col(i)) for i in ids]
    return trimmed[0] if len(trimmed) == 1 else surrogate_key(*trimmed)


def contest(
    spark: SparkSession, table: VersionTable, arrived: DataFrame, day: Column, folder: str
) -> tuple[DataFrame, DataFrame]:
    """``(before, after)``: the records that eligible rows change, as they are stored and as they will be.

    Both are tables below ``folder``; nothing is merged yet. A row that is stored already changes nothing.
    """
    columns = arrived.columns
    newest = latest_version(arrived, *table.ids)
    link = [F.trim(F.col(table.link)).alias(LINK)] if table.link else []
    newest = newest.select("*", version_key(table.ids).alias(KEY), day.alias(DAY), *link)
    if not table_exists(spark, table.rows):
        after = write_and_read(newest, f"{folder}/after")
        nothing = after.limit(0).select("*", F.lit(0).alias(BUCKET), F.lit(0).alias(MONTH))
        return write_and_read(nothing, f"{folder}/before"), after
    incoming = write_and_read(newest, f"{folder}/arrived")
    held = write_and_read(rows_of_keys(spark, table.rows, incoming).select(*incoming.columns, BUCKET, MONTH), f"{folder}/{_HELD}")
    both = incoming.withColumn(_STORED, F.lit(0)).unionByName(held.drop(BUCKET, MONTH).withColumn(_STORED, F.lit(1)))
    # The order that a pass over all versions would use; of equal rows the stored one stays.
    order = [*newest_first(), row_fingerprint(columns), F.col(_STORED).desc()]
    winners = latest_per_key(both, [KEY], order, total=True)
    after = write_and_read(winners.filter(F.col(_STORED) == 0).drop(_STORED), f"{folder}/after")
    before = write_and_read(held.join(after.select(KEY), KEY, "left_semi").select(*held.columns), f"{folder}/before")
    return before, after


def is_first_load(spark: SparkSession, folder: str) -> bool:
    """Whether ``contest`` left rows of a table that was not there yet, so all its rows are among them."""
    return path_exists(spark, f"{folder}/after") and not path_exists(spark, f"{folder}/{_HELD}")


def settle(spark: SparkSession, table: VersionTable, before: DataFrame, after: DataFrame, folder: str) -> None:
    """Store the winners that ``contest`` left below ``folder``; doing it again changes nothing."""
    upsert(spark, table.rows, after, old=before.select(KEY, BUCKET, MONTH), stored=f"{folder}/after")


def newest_rows(spark: SparkSession, table: VersionTable, like: DataFrame) -> DataFrame:
    """The stored winners, marked as such; ``like`` has the columns of a table that has no rows yet."""
    if not table_exists(spark, table.rows):
        return like.limit(0).withColumn(NEWEST, F.lit(True))
    return read_table(spark, table.rows).withColumn(NEWEST, F.lit(True))
