"""Retention campaign contacts: capped offers, consistent outcome windows, return."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.functions import dates, numeric, parsing, text
from silverlode.plans.silver.common import extracted_at, keep_if, lineage, newest_records

# Fixed values.
DISCOUNT_CAP = 100
FREE_MONTHS_CAP = 24


def clean_marketing(raw: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    today = dates.day(as_of)
    c = F.col
    newest = newest_records(raw, "marketing_retention")

    def yes(name: str):
        return F.coalesce(c(name), F.lit(False))

    staged = newest.select(
        F.trim("interaction_id").alias("interaction_id"),
        F.trim("customer_id").alias("customer_id"),
        text.blank_to_null(F.trim("campaign_id")).alias("campaign_id"),
        F.coalesce(text.blank_to_null(text.title_case(F.trim("campaign_name"))), F.lit("Unknown")).alias(
            "campaign_name"
        ),
        parsing.safe_date(raw, "contact_date").alias("contact_date_parsed"),
        parsing.safe_date(raw, "response_date").alias("response_date_source"),
        text.category(c("channel")).alias("channel_norm"),
        text.category(c("offer_type")).alias("offer_type_norm"),
        yes("accepted").alias("accepted_bool"),
        yes("upgrade_offered").alias("upgrade_offered"),
        yes("equipment_upgrade").alias("equipment_upgrade"),
        numeric.positive_amount(c("discount_pct"), 4).alias("discount_pct"),
        numeric.positive_whole(c("free_months")).alias("free_months"),
        numeric.positive_amount(c("campaign_cost")).alias("campaign_cost_num"),
        numeric.positive_amount(c("estimated_customer_value")).alias("estimated_customer_value_num"),
        *[yes(w).alias(f"{w}_source") for w in ("retained_30d", "retained_60d", "retained_90d")],
        text.blank_to_null(text.tidy(c("retention_reason"))).alias("retention_reason"),
        extracted_at(),
    )
    contact, response = c("contact_date_parsed"), c("response_date_source")
    response_ok = response.isNull() | response.between(contact, today)
    in30, in60, in90 = (c(f"retained_{d}d_source") for d in (30, 60, 90))
    broken_windows = (in90 & ~in60) | (in60 & ~in30)
    cost, value = c("campaign_cost_num"), c("estimated_customer_value_num")
    discount_ok = c("discount_pct").between(0, DISCOUNT_CAP)
    return staged.filter(contact <= today).select(
        "interaction_id",
        "customer_id",
        "campaign_id",
        "campaign_name",
        "contact_date_parsed",
        keep_if(response_ok, response).alias("response_date_parsed"),
        "response_date_source",
        "channel_norm",
        "offer_type_norm",
        "accepted_bool",
        "upgrade_offered",
        "equipment_upgrade",
        numeric.amount(F.least(c("discount_pct"), F.lit(DISCOUNT_CAP)), 4).alias("discount_pct_num"),
        F.least(c("free_months"), F.lit(FREE_MONTHS_CAP)).alias("free_months_num"),
        "campaign_cost_num",
        "estimated_customer_value_num",
        # Retained for longer implies retained for shorter.
        (in30 | in60 | in90).alias("retained_30d"),
        (in60 | in90).alias("retained_60d"),
        in90.alias("retained_90d"),
        "retained_30d_source",
        "retained_60d_source",
        "retained_90d_source",
        "retention_reason",
        numeric.ratio(value - cost, cost).alias("estimated_campaign_roi"),
        (c("discount_pct").isNull() | discount_ok).alias("dq_valid_discount"),
        response_ok.alias("dq_valid_response_date"),
        (~broken_windows).alias("dq_retention_windows_monotonic"),
        text.first_match(
            [
                (contact.isNull(), "INVALID_CONTACT_DATE"),
                (contact > today, "FUTURE_CONTACT_EXCLUDED"),
                (~response_ok, "INVALID_RESPONSE_DATE_TO_NULL"),
                (~discount_ok, "DISCOUNT_CAPPED"),
                (c("free_months") > FREE_MONTHS_CAP, "FREE_MONTHS_CAPPED"),
                (broken_windows, "RETENTION_WINDOWS_CORRECTED"),
            ],
            "VALID",
        ).alias("marketing_dq_status"),
        (response.isNotNull() | in30 | in60 | in90 | c("retention_reason").isNotNull()).alias(
            "has_post_outcome_data"
        ),
        *lineage(),
    )
