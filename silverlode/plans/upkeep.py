"""Daily upkeep: stored tables follow what arrives, without a pass over the history.

A load goes through four stages, noted in ``<root>/load``:

1. the records that the arrived rows change are written aside, as they were and as they will be;
2. they are merged into the stored newest versions, over which silver is a mere projection;
3. new values of the customer-months they touch are written aside: friction by taking away the share of the
   old records and adding that of the new ones, the snapshot for the customers whose contracts changed and for
   the months that the clock has opened;
4. those values are merged.

What is written aside is final for its load, and merging by key repeats itself. So a load that died is
taken up again at the stage it had reached, and nothing is added twice.

The clock changes records, too: one dated in the future counts from its day on. A load therefore also takes
in stored records dated between the last run and this one.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.functions import dates, numeric, parsing
from silverlode.functions.keys import row_fingerprint, surrogate_key
from silverlode.operators.latest import NEWEST
from silverlode.operators.merge import BUCKET, MONTH, MergeTable, month_of, packed, read_table, rows_of_keys, table_exists, unpacked, upsert
from silverlode.operators.storage import delete_path, path_exists, read_note, scratch_path, write_and_read, write_note
from silverlode.operators.versions import DAY, KEY, LINK, VersionTable, contest, is_first_load, newest_rows, settle
from silverlode.plans import analytic, facts
from silverlode.plans.models import Warehouse
from silverlode.plans.refresh import FRICTION, SNAPSHOT, SNAPSHOT_LOADED_AT, fact_table
from silverlode.plans.silver.common import RECORDS, RESTORE
from silverlode.sources.calendar import FIRST_DAY, LAST_DAY, YEARS_AHEAD
from silverlode.sources.raw import raw_schema

Arrivals = Mapping[str, DataFrame]

# Sources of the monthly friction, in the order of its domains.
DOMAINS = {
    "int_billing_clean": "billing_invoices",
    "int_payment_clean": "payments",
    "int_usage_clean": "service_usage",
    "int_network_clean": "network_quality",
    "int_support_clean": "support_tickets",
}
CONTRACTS = "subscriptions_contracts"
_ARRIVED, _MERGED, _VALUED, _DONE = range(4)
Records = dict[str, DataFrame]
INVOICES, PAYMENTS = "int_billing_clean", "int_payment_clean"

# Columns of the stored sums: how many rows a customer-month has, how many values each average has, and their sums.
_MONTH_KEY, _ROWS = "customer_month_key", "n_rows"
_COUNTED = tuple(f"n_{name}" for name, (_, how) in analytic.MEASURES.items() if how is F.avg)


def _sum_type(kind: str) -> str:
    found = re.fullmatch(r"decimal\((\d+),(\d+)\)", kind)
    return f"decimal({min(38, int(found[1]) + 10)},{found[2]})" if found else kind


_SUMS = {name: _sum_type(kind) for name, (kind, _) in analytic.MEASURES.items()}


def version_table(root: str, source: str) -> VersionTable:
    return VersionTable(f"{root}/versions/{source}", RECORDS[source].ids, "invoice_id" if source == "payments" else None)


def friction_table(root: str) -> MergeTable:
    return MergeTable(f"{root}/friction_sums", _MONTH_KEY, "month_start", key_fixes_month=True, digests=(_MONTH_KEY,))


def _day(rows: DataFrame, source: str) -> Column:
    column = RECORDS[source].day
    if column is None:
        return F.lit(None).cast("date")
    if isinstance(rows.schema[column].dataType, T.StringType) and source in ("network_quality", "support_tickets"):
        return parsing.safe_timestamp(rows, column).cast("date")
    return parsing.safe_date(rows, column)


def _empty(spark: SparkSession, source: str) -> DataFrame:
    return spark.createDataFrame([], raw_schema(source))


class Note(NamedTuple):
    """How far the last load has come, what it works on, its clock and that of the load before."""

    stage: int
    folder: str
    as_of: dt.date
    last: dt.date | None


class Upkeep:
    """The stored tables below one folder. One load at a time.

    Deletions do what ``deletes`` says, for the life of the tables.
    """

    def __init__(self, spark: SparkSession, root: str, deletes: str = RESTORE):
        self.spark, self.root, self.deletes = spark, root, deletes

    # Reading

    def silver(self, as_of: dt.date) -> Warehouse:
        """All models over the stored newest versions; friction comes from its sums and the snapshot from its table."""
        tables = Warehouse(self.spark, self._newest, as_of, deletes=self.deletes)
        measures = self._friction(tables)
        tables.store(FRICTION, analytic.with_region(measures, tables["int_customer_clean"]))
        if table_exists(self.spark, fact_table(self.root, SNAPSHOT)):
            tables.store(SNAPSHOT, read_table(self.spark, fact_table(self.root, SNAPSHOT)))
        return tables

    def _newest(self, source: str) -> DataFrame:
        return newest_rows(self.spark, version_table(self.root, source), _empty(self.spark, source))

    def _friction(self, tables: Warehouse) -> DataFrame:
        kinds = analytic.friction_measures(*(tables[name] for name in DOMAINS)).schema
        sums = friction_table(self.root)
        if not table_exists(self.spark, sums):
            return self.spark.createDataFrame([], kinds)
        columns = []
        for name, (_, how) in analytic.MEASURES.items():
            value = F.col(name)
            if how is F.avg:
                value = F.when(F.col(f"n_{name}") > 0, value / F.col(f"n_{name}").cast("decimal(20,0)")).otherwise(0)
            columns.append(value.cast(kinds[name].dataType).alias(name))
        return read_table(self.spark, sums).select("customer_id", "month_start", *columns)

    # Loading

    def load(self, arrivals: Arrivals, as_of: dt.date) -> None:
        """Take in raw rows, in any order and also such as are stored already, and move the clock to ``as_of``."""
        note = self._note()
        if note is not None and note.stage != _DONE:
            self._finish(*note)
        last = note.as_of if note is not None else None
        if last is not None and as_of < last:
            raise ValueError(f"the last load was as of {last}; the clock cannot go back to {as_of}")
        folder = scratch_path(self.spark, f"{self.root}/load")
        for source, rows in arrivals.items():
            eligible = rows.filter(RECORDS[source].eligible(self.deletes))
            contest(self.spark, version_table(self.root, source), eligible, _day(rows, source), f"{folder}/{source}")
        self._say(_ARRIVED, folder, as_of, last)
        self._finish(_ARRIVED, folder, as_of, last)

    def _note(self) -> Note | None:
        note = read_note(self.spark, f"{self.root}/load")
        if note is None:
            return None
        days = [note[k] and dt.date.fromisoformat(note[k]) for k in ("as_of", "last")]
        return Note(note["stage"], note["folder"], *days)

    def _say(self, stage: int, folder: str, as_of: dt.date, last: dt.date | None) -> None:
        note = {"stage": stage, "folder": folder, "as_of": as_of.isoformat(), "last": last and last.isoformat()}
        write_note(self.spark, f"{self.root}/load", note)

    def _finish(self, stage: int, folder: str, as_of: dt.date, last: dt.date | None) -> None:
        if stage == _ARRIVED:
            for source in RECORDS:
                before, after = self._changes(folder, source)
                if not after.isEmpty():
                    settle(self.spark, version_table(self.root, source), before, after, f"{folder}/{source}")
            self._say(_MERGED, folder, as_of, last)
        touched = [self._touched(folder, sources, as_of, last) for sources in (DOMAINS.values(), [CONTRACTS])]
        if stage <= _MERGED:
            if touched[0]:
                self._value_friction(folder, as_of, last)
            if touched[1]:
                self._value_snapshot(folder, as_of, last)
            self._say(_VALUED, folder, as_of, last)
        read = self.spark.read.parquet
        if touched[0]:
            value = read(f"{folder}/friction_value")
            gone = value.filter(F.col(_ROWS) <= 0).select(_MONTH_KEY)
            kept = value.filter(F.col(_ROWS) > 0)
            upsert(self.spark, friction_table(self.root), kept, gone=gone, stored=f"{folder}/friction_value")
        if touched[1]:
            upsert(self.spark, fact_table(self.root, SNAPSHOT), read(f"{folder}/snapshot"), stored=f"{folder}/snapshot")
        self._say(_DONE, folder, as_of, last)
        delete_path(self.spark, folder)

    def _touched(self, folder: str, sources: Iterable[str], as_of: dt.date, last: dt.date | None) -> bool:
        """Whether rows of one of the sources arrived, or the clock moved over stored ones."""
        moved = last is not None and last < as_of
        return any(
            path_exists(self.spark, f"{folder}/{s}/before") or moved and table_exists(self.spark, version_table(self.root, s).rows)
            for s in sources
        )

    def _changes(self, folder: str, source: str) -> tuple[DataFrame, DataFrame]:
        """Records of a source before and after the load; none where nothing arrived."""
        read = self.spark.read.parquet
        if path_exists(self.spark, f"{folder}/{source}/before"):
            return read(f"{folder}/{source}/before"), read(f"{folder}/{source}/after")
        link = [F.lit(None).cast("string").alias(LINK)] if version_table(self.root, source).link else []
        after = _empty(self.spark, source).select("*", F.lit("").alias(KEY), F.lit(None).cast("date").alias(DAY), *link)
        return after.select("*", F.lit(0).alias(BUCKET), F.lit(0).alias(MONTH)), after

    def _ripe(self, source: str, last: dt.date | None, as_of: dt.date, changed: DataFrame) -> DataFrame:
        """Unchanged records that the clock has reached since the last load."""
        table = version_table(self.root, source).rows
        columns = changed.columns
        if last is None or last == as_of or RECORDS[source].day is None or not table_exists(self.spark, table):
            return changed.limit(0)
        rows = read_table(self.spark, table).filter((F.col(DAY) > F.lit(last)) & (F.col(DAY) <= F.lit(as_of)))
        return rows.join(changed.select(KEY), KEY, "left_anti").select(*columns)

    # Friction by retraction

    def _value_friction(self, folder: str, as_of: dt.date, last: dt.date | None) -> None:
        """New sums of the customer-months that changed or ripened records touch; those without rows are empty now."""
        old, new = {}, {}
        for name, source in DOMAINS.items():
            before, after = self._changes(folder, source)
            # A payment counts whatever its date.
            ripe = after.limit(0) if name == PAYMENTS else self._ripe(source, last, as_of, after)
            old[name] = before.select(*after.columns).unionByName(ripe)
            new[name] = after.unionByName(ripe)
        others = self._rest_of_invoices(folder, old, new)
        shares = self._shares(new, others, as_of, 1).unionByName(self._shares(old, others, last or as_of, -1))
        sums = friction_table(self.root)
        if not table_exists(self.spark, sums):
            write_and_read(_summed(shares), f"{folder}/friction_value")
            return
        change = write_and_read(_summed(shares), f"{folder}/friction_change")
        months = [r[0] for r in change.select(month_of(change, "month_start")).distinct().collect()]
        held = rows_of_keys(self.spark, sums, change).filter(F.col(MONTH).isin(months))
        write_and_read(_summed(change.unionByName(held.select(*change.columns))), f"{folder}/friction_value")

    def _rest_of_invoices(self, folder: str, old: Records, new: Records) -> Records:
        """What unchanged invoices and payments the changed ones have to be joined with.

        A payment counts for the customer of its invoice, so all payments of a changed invoice, and the
        invoices of changed payments, take part on both sides.
        """
        found = {name: new[name].limit(0) for name in (PAYMENTS, INVOICES)}
        # A table that this load has made holds changed records only.
        searched = {
            name: by
            for name, by in ((PAYMENTS, LINK), (INVOICES, None))
            if table_exists(self.spark, version_table(self.root, DOMAINS[name]).rows)
            and not is_first_load(self.spark, f"{folder}/{DOMAINS[name]}")
        }
        if not searched:
            return found
        ids = [side[name].select(F.trim("invoice_id").alias("id")) for side in (old, new) for name in (INVOICES, PAYMENTS)]
        touched = write_and_read(reduce(DataFrame.union, ids).filter("id IS NOT NULL").distinct(), f"{folder}/touched")
        for name, by in searched.items():
            table = version_table(self.root, DOMAINS[name]).rows
            # The changes are merged by now: what is not among them is the same before and after.
            stored = rows_of_keys(self.spark, table, touched.withColumnRenamed("id", by or KEY), by=by)
            rest = stored.join(new[name].select(KEY), KEY, "left_anti").select(*new[name].columns)
            found[name] = write_and_read(rest, f"{folder}/rest_{name}")
        return found

    def _shares(self, changed: Records, others: Records, as_of: dt.date, sign: int) -> DataFrame:
        """What records contribute to customer-months: sums, and counts for the averages."""

        def clean(records: Records) -> dict[str, DataFrame]:
            raw = {DOMAINS[name]: rows.withColumn(NEWEST, F.lit(True)) for name, rows in records.items()}
            # Models read a source under the name of its replica.
            tables = Warehouse(self.spark, raw.__getitem__, as_of, deletes=self.deletes)
            return {name: tables[name] for name in records}

        own = clean(changed)
        joined = clean({name: changed[name].unionByName(others[name]) for name in others})
        paid = analytic.payments_of_invoices(joined[PAYMENTS], joined[INVOICES])
        rows = analytic.friction_rows(own[INVOICES], paid, *(own[n] for n in DOMAINS if n not in others))
        # Measures of other domains stay missing: no row adds their zeros.
        values = [(F.col(name) * sign).cast(_SUMS[name]).alias(name) for name in analytic.MEASURES]
        counts = [F.when(F.col(name.removeprefix("n_")).isNotNull(), sign).otherwise(0).cast("long").alias(name) for name in _COUNTED]
        key = surrogate_key("customer_id", "month_start").alias(_MONTH_KEY)
        return rows.select(key, "customer_id", "month_start", *values, *counts, F.lit(sign).cast("long").alias(_ROWS))

    # Snapshot by change sets

    def _value_snapshot(self, folder: str, as_of: dt.date, last: dt.date | None) -> None:
        """Rows of customers whose contracts changed, and of the months that the clock has opened; only such as are new."""
        contracts = Warehouse(self.spark, self._newest, as_of)["int_subscription_clean"]
        before, after = self._changes(folder, CONTRACTS)
        ripe = self._ripe(CONTRACTS, last, as_of, after)
        first = F.lit(FIRST_DAY).alias("first_month")
        wanted = [df.select(F.trim("customer_id").alias("customer_id"), first) for df in (before, after, ripe)]
        if last is not None and last < as_of:
            wanted.append(_opened(contracts, last, as_of))
        since = reduce(DataFrame.unionByName, wanted).groupBy("customer_id").agg(F.min("first_month").alias("first_month"))
        since = write_and_read(since, f"{folder}/snapshot_customers")
        rows = facts.fact_customer_month_snapshot(contracts.join(since, "customer_id"), as_of, F.col("first_month"))
        table = fact_table(self.root, SNAPSHOT)
        if table_exists(self.spark, table):
            rows = write_and_read(rows, f"{folder}/snapshot_rows")
            same = row_fingerprint(rows.columns).alias("_same")
            stored = rows_of_keys(self.spark, table, rows, [], made=[same]).select(table.key, "_same")
            wide, narrow = (packed(df, table) for df in (rows.select("*", same), stored))
            rows = unpacked(wide.join(narrow, [table.key, "_same"], "left_anti"), table).select(*rows.columns)
        write_and_read(rows.withColumn(SNAPSHOT_LOADED_AT, F.current_timestamp()), f"{folder}/snapshot")


def _summed(rows: DataFrame) -> DataFrame:
    """One row per customer-month, in the types of the stored sums."""
    names = [*analytic.MEASURES, *_COUNTED, _ROWS]
    total = rows.groupBy(_MONTH_KEY, "customer_id", "month_start").agg(*[numeric.sum_given(n).alias(n) for n in names])
    sums = [F.coalesce(n, F.lit(0)).cast(_SUMS.get(n, "long")).alias(n) for n in names]
    return total.select(_MONTH_KEY, "customer_id", "month_start", *sums)


def _opened(contracts: DataFrame, last: dt.date, as_of: dt.date) -> DataFrame:
    """Customers with contracts that cover months beyond those of the last run, and the first of these months."""

    def covered_until(day: dt.date) -> Column:
        limit = F.least(F.lit(LAST_DAY), F.add_months(F.lit(day), 12 * YEARS_AHEAD))
        return dates.month_start(F.least(F.coalesce("contract_end_date", F.lit(day)), limit))

    before, now = covered_until(last), covered_until(as_of)
    opened = contracts.filter((now > before) & (dates.month_start(F.col("contract_start_date")) <= now))
    return opened.select("customer_id", F.add_months(before, 1).alias("first_month"))
