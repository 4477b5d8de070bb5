"""Churned customers: one dated, classified event each."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.functions import dates, numeric, parsing, text
from silverlode.plans.silver.common import extracted_at, keep_if, lineage, newest_records

# Words in the reason that decide its class; the first fit is taken.
REASONS = {
    "PRICE": ("PRICE", "COST", "EXPENS"),
    "NETWORK_QUALITY": ("NETWORK", "SIGNAL", "OUTAGE"),
    "CUSTOMER_SERVICE": ("SUPPORT", "SERVICE", "ATTENTION"),
    "COMPETITOR": ("COMPET",),
    "RELOCATION": ("MOVE", "RELOCAT"),
}
# Days since the churn and the window they fall in.
RECENCY = {30: "CHURN_0_30_DAYS", 60: "CHURN_31_60_DAYS", 90: "CHURN_61_90_DAYS"}
TENURE_TOLERANCE = 1


def clean_churn(raw: DataFrame, customer: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """The newest label decides; only then are customers that stayed left out."""
    today = dates.day(as_of)
    c = F.col
    newest = newest_records(raw, "churn_labels").filter(c("churned") == 1)
    churned = newest.select(
        F.trim("customer_id").alias("customer_id"),
        parsing.safe_date(raw, "churn_date").alias("churn_date"),
        numeric.positive_whole(c("tenure_months_at_end")).alias("tenure_months_source"),
        text.category(c("churn_reason")).alias("churn_reason_raw"),
        extracted_at(),
    ).filter(c("churn_date") <= today)
    registered, churn_date = c("registration_date"), c("churn_date")
    after_registration = registered.isNull() | (churn_date >= registered)
    source = c("tenure_months_source")
    recalculated = c("tenure_months_recalculated")
    validated = churned.join(
        customer.select("customer_id", "registration_date"), "customer_id", "left"
    ).select("*", keep_if(churn_date >= registered, dates.months_between(registered, churn_date)).alias(
        "tenure_months_recalculated"
    ))
    return validated.filter(after_registration).select(
        "customer_id",
        "churn_date",
        numeric.not_below_zero(F.coalesce(recalculated, source)).alias("tenure_months_at_end"),
        "tenure_months_source",
        "tenure_months_recalculated",
        text.first_match(
            [
                *[(text.contains_any([(c("churn_reason_raw"), words)]), label) for label, words in REASONS.items()],
                (c("churn_reason_raw") == "UNKNOWN", "UNKNOWN"),
            ],
            "OTHER",
        ).alias("churn_reason"),
        "churn_reason_raw",
        F.lit("CHURNED").alias("customer_status"),
        text.first_match(
            [(churn_date >= F.date_sub(today, days), label) for days, label in RECENCY.items()],
            "CHURN_OVER_90_DAYS",
        ).alias("churn_recency_window"),
        F.datediff(today, churn_date).alias("days_since_churn"),
        after_registration.alias("dq_churn_after_registration"),
        (source.isNull() | (source >= 0)).alias("dq_valid_source_tenure"),
        text.first_match(
            [
                (churn_date.isNull(), "INVALID_CHURN_DATE"),
                (churn_date > today, "FUTURE_CHURN_EXCLUDED"),
                (churn_date < registered, "CHURN_BEFORE_REGISTRATION_EXCLUDED"),
                (source < 0, "NEGATIVE_TENURE_RECALCULATED"),
                (F.abs(source - recalculated) > TENURE_TOLERANCE, "TENURE_RECALCULATED"),
            ],
            "VALID",
        ).alias("churn_dq_status"),
        F.lit("TARGET_OUTCOME").alias("churned_field_class"),
        F.lit("POST_OUTCOME_DETAIL").alias("churn_detail_field_class"),
        *lineage(),
    )
