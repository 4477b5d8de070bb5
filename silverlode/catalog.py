"""Every model and operator as a query over a folder of base tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.functions.parsing import normalize_boolean
from silverlode.operators import checks
from silverlode.operators.incremental import changed_versions, high_water_mark, incremental_slice
from silverlode.operators.latest import EXTRACTED_AT
from silverlode.operators.merge import merge_rows, read_table
from silverlode.operators.storage import scratch_path, write_and_read
from silverlode.operators.versioned import replace_table
from silverlode.plans.facts import fact_usage_snapshot
from silverlode.plans.models import CALENDAR, MODELS, SILVER, Warehouse
from silverlode.plans.refresh import FRICTION, MART_LOADED_AT, SNAPSHOT, clustered_by_day, fact_table, load_changes, load_fact, loaded_now
from silverlode.plans.silver.common import DELETED_AT, RECORDS, RESTORE, TOMBSTONE
from silverlode.plans.silver.payment import clean_payment
from silverlode.plans.silver.support import clean_support
from silverlode.plans.silver.usage import clean_usage
from silverlode.plans.suite import CHECKS
from silverlode.plans.upkeep import CONTRACTS, Upkeep
from silverlode.session import warn_unless_configured
from silverlode.sources import derived
from silverlode.sources.raw import COLUMNS, MAX_AGE, ORDER_TABLES, read_raw

Query = Callable[[SparkSession, str], DataFrame]

# The moment freshness is judged at, and where the first of two loads ends.
NOW = dt.datetime(2024, 2, 1, 12)
FIRST_LOAD_UNTIL = dt.datetime(2024, 1, 15)
# The day of the first of two runs.
EARLIER_DAY = dt.date(2023, 7, 1)


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """All tables over raw tables that are derived as they are read."""

    def raw(source: str) -> DataFrame:
        if source in ORDER_TABLES:
            return derived.base_table(spark, sf_dir, source)
        return derived.derive(spark, source, sf_dir)

    return Warehouse(spark, raw, derived.AS_OF)


def stored_warehouse(spark: SparkSession, sf_dir: str, root: str) -> Warehouse:
    """The same tables over raw tables written below ``root`` beforehand."""

    def raw(source: str) -> DataFrame:
        if source in ORDER_TABLES:
            return derived.base_table(spark, sf_dir, source)
        return read_raw(spark, source, root)

    return Warehouse(spark, raw, derived.AS_OF)


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and timestamps without zone, as any engine has them."""

    def plain(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return column.cast("timestamp_ntz").alias(field.name)
        return column

    return df.select(*[plain(f) for f in df.schema])


def dim_date_of_invoices(tables: Warehouse) -> DataFrame:
    """Calendar attributes of the days on which invoices were issued."""
    issued = (
        tables["int_billing_clean"]
        .groupBy(F.col("issue_date").alias("calendar_date"))
        .agg(F.count(F.lit(1)).alias("invoices"))
    )
    # The calendar has a fixed number of days.
    return issued.join(F.broadcast(tables[CALENDAR]), "calendar_date")


def dq_not_null(tables: Warehouse) -> DataFrame:
    return checks.not_null(tables["stg_crm_customers"], "registration_date")


def dq_unique(tables: Warehouse) -> DataFrame:
    return checks.unique(tables["stg_service_usage"], "usage_id")


def dq_accepted_values(tables: Warehouse) -> DataFrame:
    return checks.accepted_values(tables["stg_churn_labels"], "churned", (0, 1))


def dq_relationships(tables: Warehouse) -> DataFrame:
    return checks.relationships(tables["int_usage_clean"], "customer_id", tables["int_customer_clean"], "customer_id")


def dq_between(tables: Warehouse) -> DataFrame:
    return checks.between(tables["stg_crm_customers"], "age", 18, 120)


def dq_singular(tables: Warehouse) -> DataFrame:
    """Unreasonable discounts, after some have been raised beyond the price."""
    items = tables["order_item"]
    raised = (F.col("extended_price") * -2).cast(items.schema["item_discount_amount"].dataType)
    changed = F.when(F.col("order_key") % 50 == 0, raised).otherwise(F.col("item_discount_amount"))
    return checks.discount_is_reasonable(items.withColumn("item_discount_amount", changed))


def dq_suite_silver(tables: Warehouse) -> DataFrame:
    """Failures of key checks on raw usage and of the checks on customers and tickets."""
    raw_checks = [
        checks.Check("stg_service_usage", "usage_id", "unique"),
        checks.Check("stg_crm_customers", "msisdn", "not_null"),
        checks.Check("stg_crm_customers", "age", "between", (18, 120)),
        checks.Check("stg_churn_labels", "churned", "accepted_values", (0, 1)),
    ]
    silver_checks = [c for c in CHECKS if c.model in ("int_customer_clean", "int_support_clean", "int_churn_clean")]
    wanted = [*raw_checks, *silver_checks]
    names = {c.model for c in wanted} | {"int_customer_clean"}
    return checks.run_suite({n: tables[n] for n in names}, wanted)


def freshness(tables: Warehouse) -> DataFrame:
    return checks.freshness({s: tables[f"stg_{s}"] for s in COLUMNS}, NOW, MAX_AGE)


def normalized_booleans(tables: Warehouse) -> DataFrame:
    return tables["stg_support_tickets"].select(
        "ticket_id",
        normalize_boolean(F.col("reopened")).alias("reopened"),
        normalize_boolean(F.col("first_contact_resolution"), None).alias("first_contact_resolution"),
    )


def _two_loads(tables: Warehouse) -> tuple[DataFrame, DataFrame]:
    """A usage fact as of a first load, and what a second load adds to it."""
    raw = tables["stg_service_usage"]
    first = raw.filter(F.col(EXTRACTED_AT) <= F.lit(FIRST_LOAD_UNTIL.isoformat(sep=" ")).cast("timestamp"))
    # Its mark and its rows are read: stored, it is not made twice.
    target = write_and_read(fact_usage_snapshot(clean_usage(first, tables.as_of)), _files(tables))
    mark = high_water_mark(target)
    newer = clean_usage(changed_versions(raw, mark), tables.as_of)
    return target, incremental_slice(fact_usage_snapshot(newer), mark)


def incremental_rows(tables: Warehouse) -> DataFrame:
    return _two_loads(tables)[1]


def upserted(tables: Warehouse) -> DataFrame:
    target, batch = _two_loads(tables)
    return merge_rows(target, batch, "usage_key")


def upserted_files(tables: Warehouse) -> DataFrame:
    """The usage fact as stored on files by two loads, each cleaning only raw rows newer than the table."""
    spark, name = tables.spark, "fact_usage_snapshot"
    root = scratch_path(spark, f"/tmp/checkpoints/{spark.sparkContext.applicationId}")
    table = fact_table(root, name)
    raw = tables["stg_service_usage"]
    first = raw.filter(F.col(EXTRACTED_AT) <= F.lit(FIRST_LOAD_UNTIL.isoformat(sep=" ")).cast("timestamp"))
    for rows in (first, raw):
        load_changes(spark, name, table, lambda _, rows=rows: rows, tables.as_of)
    return read_table(spark, table)


def _files(tables: Warehouse) -> str:
    return scratch_path(tables.spark, f"/tmp/checkpoints/{tables.spark.sparkContext.applicationId}")


def _with(tables: Warehouse, source: str, rows: DataFrame, as_of: dt.date | None = None, deletes: str = RESTORE) -> Warehouse:
    """The models over the same raw tables but for one."""
    return Warehouse(
        tables.spark, lambda s: rows if s == source else tables[f"stg_{s}"], as_of or tables.as_of, deletes=deletes
    )


def _number(column: str):
    return F.regexp_extract(column, "([0-9]+)", 1).cast("long")


def _damaged(tables: Warehouse) -> dict[str, DataFrame]:
    """Tables with failures of every kind."""

    def changed(name: str, **values) -> DataFrame:
        kinds = tables[name].schema
        return tables[name].withColumns({c: v.cast(kinds[c].dataType) for c, v in values.items()})

    def where(id_column: str, digit: int, value, otherwise: str):
        return F.when(F.col(id_column).endswith(str(digit)), value).otherwise(F.col(otherwise))

    usage = tables["int_usage_clean"]
    return {
        "int_customer_clean": changed(
            "int_customer_clean",
            age=where("customer_id", 7, F.col("age") + 200, "age"),
            dependents_dq_status=where("customer_id", 3, F.lit("BROKEN"), "dependents_dq_status"),
            registration_date=where("customer_id", 9, F.lit(None), "registration_date"),
        ),
        "int_usage_clean": usage.unionByName(usage.filter(F.col("usage_id").endswith("1"))),
        "int_support_clean": changed(
            "int_support_clean", satisfaction_score=where("ticket_id", 5, F.col("satisfaction_score") + 10, "satisfaction_score")
        ),
        "int_billing_clean": changed("int_billing_clean", invoice_id=where("invoice_id", 8, F.lit(None), "invoice_id")),
        "int_r5_ml_features": changed(
            "int_r5_ml_features", label_churn_next_90d=where("customer_id", 2, F.lit(5), "label_churn_next_90d")
        ),
    }


def dq_suite(tables: Warehouse) -> DataFrame:
    """All checks of all models, over stored silver, after some tables have been damaged."""
    for name in (*SILVER, FRICTION):
        tables.store(name, write_and_read(tables[name], _files(tables)))
    models = {c.model for c in CHECKS} | {c.parent for c in CHECKS if c.parent}
    return checks.run_suite({name: tables[name] for name in models} | _damaged(tables), CHECKS)


def text_dates(tables: Warehouse) -> DataFrame:
    """Payments whose dates arrive as text in five shapes, one of them unreadable."""
    raw, day = tables["stg_payments"], F.col("payment_date")
    shapes = ("yyyy-MM-dd", "M/d/yyyy", "d-MMM-yyyy", "yyyy-MM-dd '10:30:00'")
    text = F.lit("31/31/2024")
    for number, shape in enumerate(shapes):
        text = F.when(_number("payment_id") % 5 == number, F.date_format(day, shape)).otherwise(text)
    return clean_payment(raw.withColumn("payment_date", F.when(day.isNotNull(), text)), tables.as_of)


def synced_columns(tables: Warehouse) -> DataFrame:
    """The billing fact on files, after a load without one column and with one more, and a load with all of its own."""
    raw, n = tables["stg_billing_invoices"], _number("invoice_id")
    later = raw.filter((n % 3 == 0) | (n % 5 == 0)).withColumn(EXTRACTED_AT, F.col(EXTRACTED_AT) + F.expr("interval 1 day"))
    table = fact_table(_files(tables), "fact_billing")
    first = _with(tables, "billing_invoices", raw.filter(n % 3 != 0))["fact_billing"]
    load_fact(tables.spark, table, first.drop("currency").withColumn("note", F.lit("old")))
    load_fact(tables.spark, table, _with(tables, "billing_invoices", later)["fact_billing"])
    return read_table(tables.spark, table)


def snapshot_files(tables: Warehouse) -> DataFrame:
    """The month snapshot on files, merged whole as of two days; rows of contracts that changed in between stay."""
    raw = tables["stg_subscriptions_contracts"]
    table = fact_table(_files(tables), SNAPSHOT)
    for day in (EARLIER_DAY, tables.as_of):
        shifted = raw if day == tables.as_of else raw.withColumn("contract_start_date", F.date_sub("contract_start_date", 20))
        load_fact(tables.spark, table, _with(tables, "subscriptions_contracts", shifted, day)[SNAPSHOT], lookback=None)
    return read_table(tables.spark, table)


def lookback_files(tables: Warehouse) -> DataFrame:
    """The usage fact on files: of rows that come late, those of the last five days before the mark are still taken in."""
    table = fact_table(_files(tables), "fact_usage_snapshot")
    raw = tables["stg_service_usage"]
    until = F.col(EXTRACTED_AT) <= F.lit(FIRST_LOAD_UNTIL.isoformat(sep=" ")).cast("timestamp")
    for rows, back in ((raw.filter(until & (F.col("sms_count") % 3 != 0)), 0), (raw, 5)):
        load_changes(
            tables.spark, "fact_usage_snapshot", table, lambda _, rows=rows: rows, tables.as_of, lookback=dt.timedelta(days=back)
        )
    return read_table(tables.spark, table)


def _with_deletions(tables: Warehouse) -> DataFrame:
    """Tickets, of which every eleventh is deleted a day later."""
    raw = tables["stg_support_tickets"]
    deleted = raw.filter(_number("ticket_id") % 11 == 0).withColumns(
        {EXTRACTED_AT: F.col(EXTRACTED_AT) + F.expr("interval 1 day"), DELETED_AT: F.lit("2024-02-01")}
    )
    return raw.unionByName(deleted)


def tombstones(tables: Warehouse) -> DataFrame:
    return clean_support(_with_deletions(tables), tables.as_of, TOMBSTONE)


def tombstones_in_fact(tables: Warehouse) -> DataFrame:
    """The ticket fact on files: what a second load finds deleted leaves it."""
    table = fact_table(_files(tables), "fact_support_ticket")
    for rows in (tables["stg_support_tickets"], _with_deletions(tables)):
        stored = {"int_customer_clean": tables["int_customer_clean"]}
        load_changes(
            tables.spark, "fact_support_ticket", table, lambda _, rows=rows: rows, tables.as_of, stored, deletes=TOMBSTONE
        )
    return read_table(tables.spark, table)


def _kept_up(tables: Warehouse, sources: tuple[str, ...]) -> Warehouse:
    """Stored tables after two loads of raw rows that were dealt out by their ids, the first as of an earlier day."""
    keeper = Upkeep(tables.spark, _files(tables))
    for number, day in ((0, EARLIER_DAY), (1, tables.as_of)):
        rows = {s: tables[f"stg_{s}"] for s in sources}
        # Also versions of one record come with different loads.
        dealt = {s: df.filter(F.pmod(F.xxhash64(RECORDS[s].ids[0], EXTRACTED_AT), F.lit(2)) == number) for s, df in rows.items()}
        keeper.load(dealt, day)
    return keeper.silver(tables.as_of)


def friction_by_changes(tables: Warehouse) -> DataFrame:
    """Monthly friction of invoices and their payments, kept up by taking away old and adding new shares."""
    return _kept_up(tables, ("billing_invoices", "payments", "crm_customers"))[FRICTION]


def contracts_by_changes(tables: Warehouse) -> DataFrame:
    """Clean contracts over newest versions that were merged load by load."""
    return _kept_up(tables, (CONTRACTS,))["int_subscription_clean"]


def loaded_mart(tables: Warehouse) -> DataFrame:
    """A mart as it is stored: with the time of the load, which is known to lie in the day of this run."""
    stored = replace_table(loaded_now(tables["mart_r1_churn_early"]), f"{_files(tables)}/mart")
    recent = F.abs(F.unix_seconds(F.current_timestamp()) - F.unix_seconds(MART_LOADED_AT)) < 86400
    return stored.withColumn("loaded_today", recent).drop(MART_LOADED_AT)


def clustered_items(tables: Warehouse) -> DataFrame:
    """Order items as they are stored, and whether the days of their file overlap with those of another by more than a day."""
    stored = replace_table(clustered_by_day(tables["order_item"]), f"{_files(tables)}/order_item")
    files = stored.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.min("order_date").alias("low"), F.max("order_date").alias("high"))
    # One row per file.
    in_order = Window.orderBy("low", "high")
    files = files.select("file", (F.lag("high").over(in_order) > F.col("low")).alias("overlaps"))
    named = stored.select("*", F.col("_metadata.file_name").alias("file")).join(F.broadcast(files), "file").drop("file")
    return named.withColumn("overlaps", F.coalesce("overlaps", F.lit(False)))


def queried_views(tables: Warehouse) -> DataFrame:
    """Two views, joined in SQL."""
    tables.create_views()
    return tables.spark.sql(
        "SELECT c.region, s.contract_type, count(*) AS contracts, count(DISTINCT c.customer_id) AS customers"
        " FROM int_customer_clean c JOIN int_subscription_clean s USING (customer_id) GROUP BY c.region, s.contract_type"
    )


OPERATORS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "dim_date_of_invoices": dim_date_of_invoices,
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_accepted_values": dq_accepted_values,
    "dq_relationships": dq_relationships,
    "dq_between": dq_between,
    "dq_singular": dq_singular,
    "dq_suite_silver": dq_suite_silver,
    "freshness": freshness,
    "normalize_boolean": normalized_booleans,
    "incremental_slice": incremental_rows,
    "upsert": upserted,
    "upsert_files": upserted_files,
    "dq_suite": dq_suite,
    "text_dates": text_dates,
    "sync_columns_files": synced_columns,
    "snapshot_files": snapshot_files,
    "lookback_files": lookback_files,
    "deletes_tombstone": tombstones,
    "deletes_tombstone_files": tombstones_in_fact,
    "friction_by_changes": friction_by_changes,
    "contracts_by_changes": contracts_by_changes,
    "mart_r1_loaded": loaded_mart,
    "order_item_clustered": clustered_items,
    "views": queried_views,
}


def build(name: str, tables: Warehouse) -> DataFrame:
    """The result of a query over the given tables."""
    return OPERATORS[name](tables) if name in OPERATORS else tables[name]


def _run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    warn_unless_configured(spark)
    return comparable(build(name, warehouse(spark, sf_dir)))


def queries() -> dict[str, Query]:
    return {name: partial(_run, name) for name in (*MODELS, *OPERATORS)}
