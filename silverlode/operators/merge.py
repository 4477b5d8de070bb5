"""Merging new rows into a table by a unique key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.functions.keys import packed_digest, surrogate_key, unpacked_digest
from silverlode.operators.incremental import WATERMARK, high_water_mark
from silverlode.operators.storage import (
    COMPRESSION,
    child_names,
    delete_path,
    folder_bytes,
    path_exists,
    read_note,
    scratch_path,
    write_and_read,
    write_note,
)

BUCKET = "part_bucket"
MONTH = "part_month"
NO_MONTH = 0
# How large a part (a bucket of a month) may become at the first load, as rows are stored.
PART_BYTES = 256 * 1024 * 1024
# Keys that a search hands to the readers as constants; more are searched for by a join.
PUSHED_KEYS = 10_000
# Share of foreign keys for which a row group is opened in vain.
BLOOM_ERRORS = 0.00001
# Where a row of a merge comes from, and which share of a large part it belongs to.
_FROM, _SHARE = "__from", "__share"
_STORED, _NEW, _TAKEN = range(3)


class DuplicateKeys(ValueError):
    """A batch names a key more than once, so the row to keep is undecided."""


@dataclass(frozen=True)
class MergeTable:
    """A fact table on files, split by a hash bucket of the key and by month.

    ``date`` is a date, or a ``YYYYMMDD`` number, that decides the month. Where
    the key contains that date (``key_fixes_month``), a row cannot change its
    month and the rest of its bucket need not be searched for it. With
    ``sync_columns`` the table takes over the columns of each batch; otherwise
    its own columns stay. ``buckets`` split months that a single task could not
    rewrite; where their number is not given, the first load chooses it by its size, and it stays
    for the life of the table.

    Files are sorted by key and carry a Bloom filter of it, so a search for some keys opens only the row
    groups that may hold them. ``also_searched`` names further columns that get a filter. ``digests`` names
    columns of md5 text, which travel between tasks as 16 bytes. ``made_of`` names the one column that the key is the
    surrogate key of, if there is one: rows that hold it move without their key.
    """

    path: str
    key: str
    date: str
    key_fixes_month: bool = False
    sync_columns: bool = False
    buckets: int | None = None
    also_searched: tuple[str, ...] = ()
    digests: tuple[str, ...] = ()
    made_of: str | None = None

    @property
    def state(self) -> str:
        """Notes beside the table: its columns, its newest timestamp, and its number of buckets."""
        return f"{self.path}.state"


def merge_rows(target: DataFrame, batch: DataFrame, key: str, sync_columns: bool = False) -> DataFrame:
    """The target with matching rows replaced and new rows added; none is deleted."""
    kept = target.join(batch.select(key), key, "left_anti")
    columns = batch.columns if sync_columns else target.columns
    if sync_columns:
        return kept.unionByName(batch, allowMissingColumns=True).select(*columns)
    return kept.select(*columns).unionByName(batch.select(*columns))


def duplicate_keys(batch: DataFrame, key: str) -> DataFrame:
    return batch.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def _repeats_keys(rows: DataFrame, key: str) -> bool:
    """Equal keys have equal hashes, so whole keys are compared only where a hash occurs twice."""
    hashed = rows.select(F.xxhash64(key).alias("h"), key)
    twice = duplicate_keys(hashed.select("h"), "h").select("h")
    return not twice.isEmpty() and not duplicate_keys(hashed.join(twice, "h", "left_semi"), key).isEmpty()


def month_of(df: DataFrame, date: str) -> Column:
    """``YYYYMM`` of a date or a date key; rows without a date share month 0."""
    column = F.col(date)
    if df.schema[date].dataType.typeName() == "date":
        month = F.year(column) * 100 + F.month(column)
    else:
        month = (column / 100).cast("int")
    return F.coalesce(month.cast("int"), F.lit(NO_MONTH))


def bucket_of(table: MergeTable, buckets: int | None = None) -> Column:
    return F.pmod(F.xxhash64(F.col(table.key)), F.lit(buckets or table.buckets or 1)).cast("int")


def table_exists(spark: SparkSession, table: MergeTable) -> bool:
    """A table comes into being with its first row."""
    return path_exists(spark, table.path) and any(n.startswith(f"{BUCKET}=") for n in child_names(spark, table.path))


class State(NamedTuple):
    columns: T.StructType
    mark: int | None
    buckets: int


def _state(spark: SparkSession, table: MergeTable) -> State | None:
    """What the last load noted; None for no table."""
    note = read_note(spark, table.state)
    return State(T.StructType.fromJson(note["columns"]), note["mark"], note["buckets"]) if note else None


def _note_state(spark: SparkSession, table: MergeTable, state: State) -> None:
    write_note(spark, table.state, {"columns": state.columns.jsonValue(), "mark": state.mark, "buckets": state.buckets})


def _stored_rows(spark: SparkSession, table: MergeTable) -> DataFrame:
    """All columns and the two that the table is split by."""
    known = _state(spark, table)
    if known is None:
        # The note is lost; the files tell the columns.
        return spark.read.option("mergeSchema", True).parquet(table.path)
    split = [T.StructField(BUCKET, T.IntegerType()), T.StructField(MONTH, T.IntegerType())]
    return spark.read.schema(T.StructType([*known.columns.fields, *split])).parquet(table.path)


def read_table(spark: SparkSession, table: MergeTable) -> DataFrame:
    """The rows of the table, without the columns it is split by. Reading changes nothing."""
    return _stored_rows(spark, table).drop(BUCKET, MONTH)


def table_mark(spark: SparkSession, table: MergeTable) -> int | None:
    """Newest timestamp of the table, in microseconds, as the last load noted it; None for no table."""
    known = _state(spark, table)
    if known is not None:
        return known.mark
    return high_water_mark(read_table(spark, table)) if table_exists(spark, table) else None


def packed(rows: DataFrame, table: MergeTable) -> DataFrame:
    """The same rows with short digests, for moves between tasks."""
    return rows.withColumns({c: packed_digest(c) for c in table.digests if c in rows.columns})


def unpacked(rows: DataFrame, table: MergeTable) -> DataFrame:
    """The rows of ``packed`` as they were."""
    return rows.withColumns({c: unpacked_digest(c) for c in table.digests if c in rows.columns})


def _without_key(rows: DataFrame, table: MergeTable) -> DataFrame:
    """``packed`` whole rows, whose key is empty where another column makes it."""
    if table.made_of not in rows.columns or table.key not in table.digests:
        return packed(rows, table)
    made = F.col(table.key) == surrogate_key(table.made_of)
    return rows.withColumns(
        {
            **{c: packed_digest(c) for c in table.digests if c in rows.columns},
            table.key: F.when(made, F.lit(b"")).otherwise(packed_digest(table.key)),
        }
    )


def _with_key(rows: DataFrame, table: MergeTable) -> DataFrame:
    """The rows of ``_without_key`` as they were."""
    if table.made_of not in rows.columns or table.key not in table.digests:
        return unpacked(rows, table)
    key = F.when(F.length(table.key) == 0, surrogate_key(table.made_of)).otherwise(unpacked_digest(table.key))
    return rows.withColumns({**{c: unpacked_digest(c) for c in table.digests if c in rows.columns}, table.key: key})


def rows_of_keys(
    spark: SparkSession,
    table: MergeTable,
    keys: DataFrame,
    columns: list[str] | None = None,
    by: str | None = None,
    made: Sequence[Column] = (),
) -> DataFrame:
    """Stored rows with one of the keys, and the part each lies in; ``keys`` is a stored table with that column, each once.

    Up to ``PUSHED_KEYS`` keys go to the Parquet readers as constants: row groups whose Bloom filter knows none of them,
    and pages outside their range, are not read. More keys meet the key column of their buckets in a join.
    ``by`` is one of the other searched columns, to look for instead of the key. ``made`` are further columns, made
    of the stored ones before rows move between tasks.
    """
    current = _stored_rows(spark, table)
    column = by or table.key
    if columns is not None:
        current = current.select(*dict.fromkeys([table.key, column, *columns]), *made, BUCKET, MONTH)
    known = _state(spark, table)
    wanted = keys.select(column).filter(F.col(column).isNotNull())
    few = [r[0] for r in wanted.limit(PUSHED_KEYS + 1).collect()]
    if by is None and known is not None:
        buckets = [r[0] for r in wanted.select(bucket_of(table, known.buckets)).distinct().collect()]
        current = current.filter(F.col(BUCKET).isin(buckets))
    if len(few) <= PUSHED_KEYS:
        return current.filter(F.col(column).isin(few))
    return unpacked(packed(current, table).join(packed(wanted, table), column, "left_semi"), table)


def upsert(
    spark: SparkSession,
    table: MergeTable,
    batch: DataFrame,
    old: DataFrame | None = None,
    gone: DataFrame | None = None,
    stored: str | None = None,
) -> None:
    """Merge a batch into the table, rewriting only the buckets of months that it touches.

    ``old`` holds the keys of stored rows that the batch replaces and the parts (two columns) they lie in, if that is
    known already. ``gone`` holds keys whose rows are taken away; none of them is in the batch. ``stored`` is the folder
    that the batch is read from, if it is a stored table; others are stored first.

    What a load writes last is the mark. One that died before that is simply run
    again: its batch is still newer than the mark, and merging by key repeats
    itself, also over months that were already rewritten or not yet emptied.
    One writer at a time; readers in between may see a part of the load.
    """
    scratch = scratch_path(spark, table.path)
    rows = batch if stored else write_and_read(batch, f"{scratch}/batch")
    rows = rows.withColumn(MONTH, month_of(rows, table.date))
    try:
        if gone is not None and (gone.isEmpty() or not table_exists(spark, table)):
            gone = None
        if rows.isEmpty() and gone is None:
            return
        if _repeats_keys(rows, table.key):
            raise DuplicateKeys(f"batch for {table.path} repeats values of {table.key}")
        known = _state(spark, table)
        mark = high_water_mark(rows) if WATERMARK in batch.columns else None
        columns = batch.schema
        if known is None:
            known = State(columns, None, table.buckets or _buckets_for(spark, table, rows, stored or f"{scratch}/batch"))
            # Which bucket a key lies in is known before the first row is stored.
            _note_state(spark, table, known)
        rows = rows.withColumn(BUCKET, bucket_of(table, known.buckets)).select(*batch.columns, BUCKET, MONTH)
        if table_exists(spark, table):
            current = _stored_rows(spark, table)
            if not table.sync_columns:
                columns = current.drop(BUCKET, MONTH).schema
            mark = max((m for m in (mark, table_mark(spark, table)) if m is not None), default=None)
            _rewrite(spark, table, current, rows, old, gone, f"{scratch}/taken")
        else:
            _write_parts(_in_order(rows, table), table)
        _note_state(spark, table, State(columns, mark, known.buckets))
    finally:
        delete_path(spark, scratch)


def _buckets_for(spark: SparkSession, table: MergeTable, rows: DataFrame, path: str) -> int:
    """So many buckets that no part of the first load is beyond its size, and where the note is lost, as many as there are."""
    if table_exists(spark, table):
        return 1 + max(int(n.removeprefix(f"{BUCKET}=")) for n in child_names(spark, table.path) if n.startswith(f"{BUCKET}="))
    sizes = rows.groupBy(MONTH).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("all"), F.max("n").alias("most")).first()
    return max(1, round(folder_bytes(spark, path) * sizes["most"] / sizes["all"] / PART_BYTES))


def _in_order(rows: DataFrame, table: MergeTable) -> DataFrame:
    """Rows of a part together and sorted by key; adaptive execution splits a large part into several files."""
    together = _without_key(rows, table).hint("rebalance", BUCKET, MONTH)
    return _with_key(together, table).sortWithinPartitions(BUCKET, MONTH, table.key)


def _write_parts(rows: DataFrame, table: MergeTable) -> None:
    """Replace the parts that the rows belong to. Spark writes them aside first, so they may be read from the table itself."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET, MONTH)
    for column in (table.key, *table.also_searched):
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer = writer.option(f"parquet.bloom.filter.fpp#{column}", str(BLOOM_ERRORS))
    writer = writer.option("compression", COMPRESSION)
    # A filter takes the size its keys need, up to that of a row group of some million keys.
    writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true").option("parquet.bloom.filter.max.bytes", str(8 << 20))
    writer.parquet(table.path)


def _among(parts: list[tuple[int, int]]) -> Column:
    """Whether a row lies in one of the parts, in a form that selects folders."""
    of_bucket: dict[int, list[int]] = {}
    for bucket, month in parts:
        of_bucket.setdefault(bucket, []).append(month)
    wanted = F.lit(False)
    for bucket, months in of_bucket.items():
        wanted |= (F.col(BUCKET) == bucket) & F.col(MONTH).isin(months)
    return wanted


def _parts(df: DataFrame) -> list[tuple[int, int]]:
    """At most one pair per bucket and calendar month comes to the driver."""
    return sorted(tuple(r) for r in df.select(BUCKET, MONTH).distinct().collect())


def _rewrite(
    spark: SparkSession,
    table: MergeTable,
    current: DataFrame,
    rows: DataFrame,
    old: DataFrame | None,
    gone: DataFrame | None,
    folder: str,
) -> None:
    own = _parts(rows)
    place = [table.key, BUCKET, MONTH]
    # Keys and parts of stored rows that leave a part which the batch may have no row of theirs in.
    taken = []
    if old is not None:
        taken.append(old.select(*place))
    elif not table.key_fixes_month and own:
        taken.append(rows_of_keys(spark, table, rows, []).select(*place))
    if gone is not None:
        taken.append(rows_of_keys(spark, table, gone, []).select(*place))
    out = write_and_read(reduce(DataFrame.union, taken), folder) if taken else rows.select(*place).limit(0)
    left = sorted(set(_parts(out)) - set(own)) if taken else []
    emptied = set()
    if left:
        kept = current.filter(_among(left)).select(*place).join(out, place, "left_anti")
        emptied = set(left) - set(_parts(kept))
    parts = [*own, *left]
    if not parts:
        return
    merged = _merge_parts(current.filter(_among(parts)), rows, out, table, _shares_of(spark, table, parts))
    _write_parts(merged, table)
    for bucket, month in sorted(emptied):
        # All rows of this part have moved to another month or are gone.
        delete_path(spark, f"{table.path}/{BUCKET}={bucket}/{MONTH}={month}")


def _shares_of(spark: SparkSession, table: MergeTable, parts: list[tuple[int, int]]) -> int:
    """So many tasks share a part that none rewrites much more than the size of one."""
    folders = (f"{table.path}/{BUCKET}={bucket}/{MONTH}={month}" for bucket, month in parts)
    return max(1, -(-max(folder_bytes(spark, f) if path_exists(spark, f) else 0 for f in folders) // PART_BYTES))


def _merge_parts(current: DataFrame, rows: DataFrame, out: DataFrame, table: MergeTable, shares: int) -> DataFrame:
    """Parts without the stored rows that are replaced or taken out, with those of the batch, sorted by key.

    Stored and new rows and the keys to take out meet in one exchange by part, in which a part is written as well.
    """
    columns = rows.columns if table.sync_columns else current.columns
    new = rows if table.sync_columns else rows.select(*columns)
    both = current.withColumn(_FROM, F.lit(_STORED)).unionByName(new.withColumn(_FROM, F.lit(_NEW)), allowMissingColumns=True)
    both = both.select(*columns, _FROM).unionByName(out.withColumn(_FROM, F.lit(_TAKEN)), allowMissingColumns=True)
    both = both.withColumn(_SHARE, F.pmod(F.xxhash64(table.key, F.lit(1)), F.lit(shares)))
    met = _with_key(_without_key(both, table).repartition(BUCKET, MONTH, _SHARE), table)
    order = [BUCKET, MONTH, table.key, _SHARE]
    newest = F.max(_FROM).over(Window.partitionBy(*order))
    # A null key replaces nothing.
    stays = (F.col(_FROM) == _NEW) | (F.col(_FROM) == _STORED) & ((F.col("__newest_from") == _STORED) | F.col(table.key).isNull())
    return met.withColumn("__newest_from", newest).filter(stays).sortWithinPartitions(*order).select(*columns)


def merge_into(batch: DataFrame, table: str, key: str) -> None:
    """The same merge for a catalog table whose format supports row-level changes."""
    (
        batch.mergeInto(table, F.expr(f"{table}.{key} = source.{key}"))
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )
