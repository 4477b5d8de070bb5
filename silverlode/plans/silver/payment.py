"""Payments: recalculated balance, its variance, and collection friction."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.functions import dates, numeric, parsing, text
from silverlode.plans.silver.common import extracted_at, lineage, newest_records

# Spellings of each status, and tolerances.
STATUSES = {
    "COMPLETED": ("COMPLETED", "PAID", "SUCCESS", "SUCCEEDED"),
    "FAILED": ("FAILED", "DECLINED", "REJECTED"),
    "PARTIAL": ("PARTIAL", "PARTIALLY_PAID"),
    "PENDING": ("PENDING", "PROCESSING"),
}
OVERPAYMENT = Decimal("1.05")
BALANCE_TOLERANCE = "0.05"


def clean_payment(raw: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """No row is dropped for its date: missing and future payment dates stay."""
    today = dates.day(as_of)
    c = F.col
    newest = newest_records(raw, "payments")
    staged = newest.select(
        *[F.trim(i).alias(i) for i in ("payment_id", "invoice_id", "customer_id")],
        parsing.safe_date(raw, "payment_date").alias("payment_date"),
        text.category(c("payment_method")).alias("payment_method"),
        text.map_codes(c("payment_status"), STATUSES).alias("payment_status"),
        text.category(c("collection_action"), "NONE").alias("collection_action"),
        *[
            numeric.positive_amount(c(a)).alias(a)
            for a in ("amount_due", "amount_paid", "outstanding_balance")
        ],
        *[numeric.positive_whole(c(n)).alias(n) for n in ("days_late", "failed_attempts")],
        extracted_at(),
    )
    due, paid, reported = c("amount_due"), c("amount_paid"), c("outstanding_balance")
    open_amount = numeric.not_below_zero(due - paid)
    overpaid = paid > due * F.lit(OVERPAYMENT)
    reconciles = numeric.close_to(reported, open_amount, BALANCE_TOLERANCE)
    return staged.select(
        "payment_id",
        "invoice_id",
        "customer_id",
        "payment_date",
        "payment_method",
        "payment_status",
        "collection_action",
        "amount_due",
        "amount_paid",
        numeric.amount(open_amount).alias("outstanding_balance"),
        reported.alias("outstanding_balance_source"),
        numeric.amount(reported - open_amount).alias("outstanding_balance_variance"),
        "days_late",
        "failed_attempts",
        (due.isNull() | (due >= 0)).alias("dq_valid_amount_due"),
        (paid.isNull() | (paid >= 0)).alias("dq_valid_amount_paid"),
        (reported.isNull() | (reported >= 0)).alias("dq_valid_outstanding_source"),
        (~overpaid | (due == 0)).alias("dq_payment_not_materially_overpaid"),
        reconciles.alias("dq_outstanding_reconciles"),
        text.first_match(
            [
                (c("payment_date") > today, "FUTURE_PAYMENT_DATE_REVIEW"),
                (due.isNull() | paid.isNull(), "NULL_AMOUNT_IMPUTED_ZERO"),
                ((due < 0) | (paid < 0), "NEGATIVE_AMOUNT_CORRECTED"),
                (overpaid & (due > 0), "OVERPAYMENT_REVIEW"),
                (~reconciles, "BALANCE_RECALCULATED"),
            ],
            "VALID",
        ).alias("payment_dq_status"),
        text.first_match(
            [(c("days_late").isNull(), "IMPUTED_ZERO"), (c("days_late") < 0, "CORRECTED_TO_ZERO")], "VALID"
        ).alias("days_late_dq_status"),
        *lineage(),
    )
