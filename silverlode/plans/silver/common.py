"""What all silver models share."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.functions import parsing, text
from silverlode.operators.latest import EXTRACTED_AT, latest_version

# What a deletion does: the version before it comes back, or the record is gone.
RESTORE, TOMBSTONE = "restore", "tombstone"
DELETED_AT = "_ab_cdc_deleted_at"
# Ages a customer can have.
AGES = (18, 120)


@dataclass(frozen=True)
class Records:
    """What identifies a record of a raw table, which of its rows can be one, and the column of the day it belongs to."""

    ids: tuple[str, ...]
    also: Callable[[], Column] | None = None
    day: str | None = None
    deletable: bool = False
    customer: bool = True

    def eligible(self, deletes: str = RESTORE) -> Column:
        named = dict.fromkeys([*self.ids, *(("customer_id",) if self.customer else ())])
        tests = [text.has_text(F.col(i)) for i in named if i != "year_month"]
        if self.also is not None:
            tests.append(self.also())
        if self.deletable and deletes == RESTORE:
            tests.append(F.col(DELETED_AT).isNull())
        found = tests[0]
        for test in tests[1:]:
            found &= test
        return found


def _not_negative(*names: str) -> Column:
    tests = [F.coalesce(F.col(n), F.lit(0)) >= 0 for n in names]
    return tests[0] if len(tests) == 1 else tests[0] & tests[1]


def _month() -> Column:
    return parsing.is_month_key(F.trim("year_month"))


RECORDS: dict[str, Records] = {
    "crm_customers": Records(("customer_id",), lambda: F.col("age").between(*AGES)),
    "subscriptions_contracts": Records(("subscription_id",), lambda: F.col("contract_start_date").isNotNull(), "contract_start_date"),
    "billing_invoices": Records(
        ("invoice_id",), lambda: F.col("issue_date").isNotNull() & _not_negative("total_amount"), "issue_date"
    ),
    "payments": Records(("payment_id",), lambda: _not_negative("amount_due", "amount_paid"), "payment_date"),
    "service_usage": Records(("usage_id",), lambda: F.col("usage_date").isNotNull(), "usage_date"),
    "network_quality": Records(("event_id",), day="timestamp", deletable=True),
    "support_tickets": Records(("ticket_id",), day="created_at", deletable=True),
    "marketing_retention": Records(("interaction_id",), lambda: F.col("contact_date").isNotNull(), "contact_date"),
    "churn_labels": Records(("customer_id",), lambda: F.col("churned").isin(0, 1)),
    "macro_monthly": Records(("year_month",), _month, customer=False),
    "metas_retencion_region_mes": Records(("target_id",), _month, customer=False),
    "xref_customer_id": Records(("account_id", "customer_id")),
}


def newest_records(raw: DataFrame, source: str, deletes: str = RESTORE) -> DataFrame:
    """The newest eligible version of each record of a source."""
    records = RECORDS[source]
    newest = latest_version(raw.filter(records.eligible(deletes)), *records.ids)
    return newest.filter(F.col(DELETED_AT).isNull()) if records.deletable and deletes == TOMBSTONE else newest


def extracted_at() -> Column:
    return F.col(EXTRACTED_AT).cast("timestamp").alias("source_extracted_at")


def lineage() -> list[Column]:
    """Origin columns at the end of every model."""
    return [
        F.lit(False).alias("source_is_deleted"),
        F.lit(None).cast("string").alias("source_raw_id"),
        F.col("source_extracted_at"),
        F.lit(None).cast("decimal(38,0)").alias("source_generation_id"),
    ]


def keep_if(test: Column, value: Column) -> Column:
    """The value where the test holds, else NULL."""
    return F.when(test, value)


def not_before(value: Column, bound: Column) -> Column:
    """True where the value is missing or not before the bound."""
    return value.isNull() | (value >= bound)
