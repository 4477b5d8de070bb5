"""One run over all layers: silver, dimensions, facts, marts, checks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.functions.keys import surrogate_key
from silverlode.operators import checks
from silverlode.operators.incremental import changed_versions, incremental_slice
from silverlode.operators.latest import latest_version
from silverlode.operators.merge import MergeTable, read_table, table_exists, table_mark, upsert
from silverlode.operators.storage import delete_path, scratch_path, write_and_read
from silverlode.operators.versioned import replace_table
from silverlode.plans.models import (
    CALENDAR,
    DIMENSIONS,
    FACTS,
    MARTS,
    ORDER_MART,
    SILVER,
    Warehouse,
)
from silverlode.plans.silver.common import DELETED_AT, RECORDS, RESTORE, TOMBSTONE
from silverlode.plans.suite import CHECKS
from silverlode.session import warn_unless_configured

# Names of the load time in the stored tables.
MART_LOADED_AT = "dbt_loaded_at"
SNAPSHOT_LOADED_AT = "dw_loaded_at"
SNAPSHOT = "fact_customer_month_snapshot"
FRICTION = "int_r3_friction_monthly"

# Key of each fact, the date it is split by, and how it is merged.
_FACT_TABLES = {
    "fact_billing": ("billing_key", "issue_date_key", {"sync_columns": True}),
    "fact_payment": ("payment_key", "payment_date", {}),
    "fact_usage_snapshot": ("usage_key", "usage_date_key", {}),
    "fact_network_event": ("network_event_key", "event_date_key", {"sync_columns": True}),
    "fact_support_ticket": ("support_ticket_key", "created_date_key", {"sync_columns": True}),
    "fact_marketing_interaction": ("marketing_interaction_key", "contact_date_key", {"sync_columns": True}),
    "fact_churn_event": ("churn_event_key", "churn_date_key", {"sync_columns": True, "key_fixes_month": True}),
    "fact_subscription_event": (
        "subscription_event_key",
        "start_date_key",
        {"sync_columns": True, "key_fixes_month": True},
    ),
    "fact_macro_monthly": ("macro_month_key", "month_date_key", {"key_fixes_month": True}),
    "fact_retention_target_monthly": ("retention_target_key", "month_date_key", {}),
    SNAPSHOT: ("customer_month_key", "month_date_key", {"key_fixes_month": True}),
}


# The raw table whose rows each fact has one of.
FACT_SOURCES = {
    "fact_billing": "billing_invoices",
    "fact_payment": "payments",
    "fact_usage_snapshot": "service_usage",
    "fact_network_event": "network_quality",
    "fact_support_ticket": "support_tickets",
    "fact_marketing_interaction": "marketing_retention",
    "fact_churn_event": "churn_labels",
    "fact_subscription_event": "subscriptions_contracts",
    "fact_macro_monthly": "macro_monthly",
    "fact_retention_target_monthly": "metas_retencion_region_mes",
}


# Surrogate keys that facts hold besides their own.
_DIGESTS = ("customer_key", "subscription_key", "plan_key", "region_key", "network_node_key", "agent_team_key", "campaign_key")


# The column whose surrogate key is the key of the fact, in facts that hold it.
_MADE_OF = {
    "fact_billing": "invoice_id",
    "fact_payment": "payment_id",
    "fact_usage_snapshot": "usage_id",
    "fact_network_event": "event_id",
    "fact_support_ticket": "ticket_id",
}


def fact_table(root: str, name: str) -> MergeTable:
    key, date, options = _FACT_TABLES[name]
    return MergeTable(f"{root}/{name}", key, date, digests=(key, *_DIGESTS), made_of=_MADE_OF.get(name), **options)


def load_fact(
    spark: SparkSession, table: MergeTable, rows: DataFrame, lookback: dt.timedelta | None = dt.timedelta(0)
) -> None:
    """Merge the rows that are newer than the table; ``lookback=None`` merges all."""
    if lookback is not None and table_exists(spark, table):
        rows = incremental_slice(rows, table_mark(spark, table), lookback=lookback)
    upsert(spark, table, rows)


def load_changes(
    spark: SparkSession,
    name: str,
    table: MergeTable,
    raw: Callable[[str], DataFrame],
    as_of: dt.date | None = None,
    stored: Mapping[str, DataFrame] | None = None,
    lookback: dt.timedelta = dt.timedelta(0),
    deletes: str = RESTORE,
) -> None:
    """Merge what is new, cleaning only the raw rows that came since the last load.

    The fact ends up as if all of its silver table had been built and sliced,
    but the history is not read. ``stored`` holds the tables it is joined with.
    With ``deletes="tombstone"`` records whose newest version is a deletion leave the fact.
    """
    source = FACT_SOURCES[name]
    exists = table_exists(spark, table)
    mark = table_mark(spark, table)

    def newer(wanted: str) -> DataFrame:
        rows = raw(wanted)
        return changed_versions(rows, mark, lookback) if wanted == source else rows

    rows = Warehouse(spark, newer, as_of, stored, deletes)[name]
    rows = incremental_slice(rows, mark, lookback=lookback) if exists else rows
    if deletes == RESTORE or not RECORDS[source].deletable or not exists:
        upsert(spark, table, rows)
        return
    folder = scratch_path(spark, f"{table.path}.gone")
    try:
        upsert(spark, table, rows, gone=write_and_read(deleted_keys(newer(source), source, table.key), folder))
    finally:
        delete_path(spark, folder)


def deleted_keys(raw: DataFrame, source: str, key: str) -> DataFrame:
    """Keys of the records whose newest version is a deletion."""
    records = RECORDS[source]
    newest = latest_version(raw.filter(records.eligible(TOMBSTONE)), *records.ids)
    ids = [F.trim(F.col(i)) for i in records.ids]
    return newest.filter(F.col(DELETED_AT).isNotNull()).select(surrogate_key(*ids).alias(key))


def clustered_by_day(order_item: DataFrame) -> DataFrame:
    """In the order of days, so a range of dates reads few files.

    The key is part of the ranges: rows of one crowded day spread over many.
    """
    clustered = order_item.repartitionByRange("order_date", "order_key", "line_number")
    return clustered.sortWithinPartitions("order_date", "order_key", "line_number")


def refresh(
    spark: SparkSession,
    raw: Callable[[str], DataFrame],
    root: str,
    as_of: dt.date | None = None,
    with_orders: bool = False,
) -> Warehouse:
    """Bring all stored tables below ``root`` up to date and return them.

    Silver is written once and read back, where plain views would clean the raw
    tables again for each of the tables built on them. Facts only merge what is
    new; the monthly snapshot has no watermark and is merged whole. Tables that are built anew get a new
    version, so who reads the old one is not disturbed; while they are written, their checks of
    single rows are counted (``Warehouse.counted``). ``plans.upkeep`` keeps silver, friction and
    snapshot up without building them anew.
    """
    warn_unless_configured(spark)
    tables = Warehouse(spark, raw, as_of)

    def rebuild(name: str, rows: DataFrame) -> None:
        watched, counts = checks.observed(rows, [c for c in CHECKS if c.model == name])
        tables.store(name, replace_table(watched, f"{root}/{name}"))
        tables.counted |= counts()

    for name in (*SILVER, CALENDAR, *DIMENSIONS):
        rebuild(name, tables[name])
    for name in FACTS:
        table = fact_table(root, name)
        if name == SNAPSHOT:
            rows = tables[name].withColumn(SNAPSHOT_LOADED_AT, F.current_timestamp())
            load_fact(spark, table, rows, lookback=None)
        else:
            rows = tables[name]
            load_fact(spark, table, rows)
        stored = read_table(spark, table) if table_exists(spark, table) else spark.createDataFrame([], rows.schema)
        tables.store(name, stored)
    # Read by two marts.
    rebuild(FRICTION, tables[FRICTION])
    for name in MARTS:
        rebuild(name, loaded_now(tables[name]))
    if with_orders:
        rebuild("order_item", clustered_by_day(tables["order_item"]))
    return tables


def loaded_now(mart: DataFrame) -> DataFrame:
    return mart.withColumn(MART_LOADED_AT, F.current_timestamp())


def check(tables: Warehouse, with_orders: bool = False) -> DataFrame:
    """Failures of every check of the models; those counted while a table was written cost no second scan."""
    wanted = [c for c in CHECKS if with_orders or c.model not in ORDER_MART]
    return checks.run_suite({c.model: tables[c.model] for c in wanted}, wanted, tables.counted)
