"""Subscriptions: one row per contract that has started."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.functions import dates, numeric, parsing, text
from silverlode.plans.silver.common import extracted_at, keep_if, lineage, newest_records, not_before

# Spellings of each status and contract type.
STATUSES = {
    "ACTIVE": ("ACTIVE", "ACTIVO", "ENABLED"),
    "CANCELLED": ("CANCELLED", "CANCELED", "INACTIVE", "BAJA"),
    "SUPERSEDED": ("SUPERSEDED", "REPLACED"),
}
CONTRACT_TYPES = {
    "MONTH_TO_MONTH": ("MONTH-TO-MONTH", "MONTH TO MONTH", "MENSUAL"),
    "ONE_YEAR": ("ONE YEAR", "1 YEAR", "ANNUAL"),
    "TWO_YEAR": ("TWO YEAR", "2 YEAR", "BIENNIAL"),
}
# Raw service flags and the columns they become.
SERVICES = {
    "phone_service": "has_phone_service",
    "multiple_lines": "has_multiple_lines",
    "internet_service": "has_internet_service",
    "online_security": "has_online_security",
    "online_backup": "has_online_backup",
    "device_protection": "has_device_protection",
    "tech_support": "has_tech_support",
    "streaming_tv": "has_streaming_tv",
    "streaming_movies": "has_streaming_movies",
    "paperless_billing": "paperless_billing",
}


def clean_subscription(raw: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    today = dates.day(as_of)
    c = F.col
    newest = newest_records(raw, "subscriptions_contracts")
    staged = newest.select(
        F.trim("subscription_id").alias("subscription_id"),
        F.trim("customer_id").alias("customer_id"),
        text.map_codes(c("status"), STATUSES).alias("status"),
        text.category(c("plan_name")).alias("plan_name"),
        text.category(c("plan_tier")).alias("plan_tier"),
        # A contract type nobody mapped is kept as it is.
        text.map_codes(c("contract_type"), CONTRACT_TYPES, text.category(c("contract_type"))).alias("contract_type"),
        parsing.safe_date(raw, "contract_start_date").alias("contract_start_date"),
        parsing.safe_date(raw, "contract_end_date").alias("contract_end_date_source"),
        parsing.safe_date(raw, "plan_change_date").alias("plan_change_date_source"),
        text.blank_to_null(text.tidy(c("previous_plan"))).alias("previous_plan"),
        numeric.positive_amount(c("base_monthly_price")).alias("base_monthly_price"),
        *[parsing.flag(c(name)).alias(out) for name, out in SERVICES.items()],
        extracted_at(),
    )
    start = c("contract_start_date")
    end_ok = not_before(c("contract_end_date_source"), start)
    change_ok = not_before(c("plan_change_date_source"), start)
    end = keep_if(end_ok, c("contract_end_date_source"))
    changed = c("plan_change_date_source").isNotNull()
    return staged.filter(start <= today).select(
        "subscription_id",
        "customer_id",
        "status",
        "plan_name",
        "plan_tier",
        "contract_type",
        "contract_start_date",
        end.alias("contract_end_date"),
        "contract_end_date_source",
        keep_if(change_ok, c("plan_change_date_source")).alias("plan_change_date"),
        "plan_change_date_source",
        "previous_plan",
        "base_monthly_price",
        *SERVICES.values(),
        end_ok.alias("dq_valid_contract_dates"),
        change_ok.alias("dq_valid_plan_change_date"),
        (~changed | c("previous_plan").isNotNull()).alias("dq_plan_change_has_previous_plan"),
        text.first_match(
            [
                (start.isNull(), "INVALID_START_DATE"),
                (start > today, "FUTURE_START_EXCLUDED"),
                (c("contract_end_date_source") < start, "INVALID_END_DATE_TO_NULL"),
                (c("plan_change_date_source") < start, "INVALID_PLAN_CHANGE_TO_NULL"),
                (changed & c("previous_plan").isNull(), "MISSING_PREVIOUS_PLAN"),
                (c("base_monthly_price").isNull(), "PRICE_IMPUTED_ZERO"),
                (c("base_monthly_price") < 0, "NEGATIVE_PRICE_CORRECTED"),
            ],
            "VALID",
        ).alias("subscription_dq_status"),
        ((c("status") == "ACTIVE") & (end.isNull() | (end >= today))).alias("is_active_subscription"),
        ((c("status") == "CANCELLED") | F.coalesce(end < today, F.lit(False))).alias("churn_candidate_flag"),
        dates.months_between(start, F.coalesce(end, today)).alias("tenure_months"),
        *lineage(),
    )
