"""Invoices: corrected components, a recalculated total and its variance."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.functions import dates, numeric, parsing, text
from silverlode.plans.silver.common import extracted_at, keep_if, lineage, newest_records, not_before

# Fixed values.
ADDED = ("base_charge", "service_charge", "equipment_charge", "extra_usage_charge", "tax")
DEFAULT_CURRENCY = "BOB"
TOTAL_TOLERANCE = "0.05"


def clean_billing(raw: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    today = dates.day(as_of)
    c = F.col
    newest = newest_records(raw, "billing_invoices")
    staged = newest.select(
        *[F.trim(i).alias(i) for i in ("invoice_id", "customer_id", "subscription_id", "account_id")],
        parsing.safe_date(raw, "issue_date").alias("issue_date"),
        parsing.safe_date(raw, "due_date").alias("due_date_source"),
        text.category(c("invoice_status")).alias("invoice_status"),
        text.category(c("currency"), DEFAULT_CURRENCY).alias("currency"),
        *[numeric.positive_amount(c(a)).alias(a) for a in (*ADDED, "discount", "previous_month_amount")],
        numeric.amount(c("total_amount")).alias("total_amount"),
        numeric.positive_amount(c("total_amount")).alias("total_amount_source"),
        numeric.amount_or_zero(c("amount_change")).alias("amount_change"),
        numeric.amount_or_zero(c("amount_change_pct"), 4).alias("amount_change_pct"),
        extracted_at(),
    )
    owed = sum((c(a) for a in ADDED[1:]), c(ADDED[0])) - c("discount")
    reconciled = staged.filter(c("issue_date") <= today).select(
        "*", numeric.positive_amount(owed).alias("total_amount_recalculated")
    )
    due_ok = not_before(c("due_date_source"), c("issue_date"))
    variance = c("total_amount_source") - c("total_amount_recalculated")
    matches = F.abs(variance) <= F.lit(TOTAL_TOLERANCE).cast("decimal(18,2)")
    return reconciled.select(
        "invoice_id",
        "customer_id",
        "subscription_id",
        "account_id",
        "issue_date",
        keep_if(due_ok, c("due_date_source")).alias("due_date"),
        "due_date_source",
        dates.month_key(c("issue_date")).alias("billing_period"),
        "invoice_status",
        "currency",
        *ADDED,
        "discount",
        "total_amount_source",
        "total_amount_recalculated",
        numeric.amount(variance).alias("amount_variance"),
        "previous_month_amount",
        "amount_change",
        "amount_change_pct",
        due_ok.alias("dq_valid_dates"),
        (c("total_amount_source") >= 0).alias("dq_nonnegative_total"),
        matches.alias("dq_total_match"),
        text.first_match(
            [
                (c("due_date_source") < c("issue_date"), "INVALID_DUE_DATE_TO_NULL"),
                (~matches, "TOTAL_MISMATCH_REVIEW"),
                (c("total_amount").isNull(), "TOTAL_IMPUTED_ZERO"),
            ],
            "VALID",
        ).alias("billing_dq_status"),
        *lineage(),
    )
