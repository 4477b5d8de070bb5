"""Service usage: capped metrics, totals, and peak/off-peak reconciliation."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.functions import dates, numeric, parsing, text
from silverlode.plans.silver.common import extracted_at, lineage, newest_records

# Decimal places of each metric, caps, tolerance.
METRIC_SCALES = {
    "data_download_gb": 4,
    "data_upload_gb": 4,
    "voice_minutes": 2,
    "streaming_hours": 2,
    "avg_session_minutes": 2,
    "international_minutes": 2,
    "peak_usage_gb": 4,
    "offpeak_usage_gb": 4,
}
COUNTS = ("sms_count", "total_session_count")
HOURS_PER_DAY = 24
MINUTES_PER_DAY = 1440
COMPONENT_TOLERANCE = Decimal("0.10")


def clean_usage(raw: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    today = dates.day(as_of)
    c = F.col
    newest = newest_records(raw, "service_usage")
    staged = newest.select(
        F.trim("usage_id").alias("usage_id"),
        F.trim("customer_id").alias("customer_id"),
        parsing.safe_date(raw, "usage_date").alias("usage_date"),
        *[numeric.positive_amount(c(m), scale).alias(m) for m, scale in METRIC_SCALES.items()],
        *[numeric.positive_whole(c(n)).alias(n) for n in COUNTS],
        extracted_at(),
    )
    down, up, voice, sms = (c(m) for m in ("data_download_gb", "data_upload_gb", "voice_minutes", "sms_count"))
    hours, sessions, minutes = c("streaming_hours"), c("total_session_count"), c("avg_session_minutes")
    capped_hours = numeric.amount(F.least(hours, F.lit(HOURS_PER_DAY)))
    gap = F.abs(c("peak_usage_gb") + c("offpeak_usage_gb") - down)
    reconciles = gap <= F.greatest(F.lit(COMPONENT_TOLERANCE), down * F.lit(COMPONENT_TOLERANCE))
    # None of the metrics is negative, so their sum is positive if one of them is.
    active = (down > 0) | (up > 0) | (voice > 0) | (sms > 0) | (capped_hours > 0)
    return staged.filter(c("usage_date") <= today).select(
        "usage_id",
        "customer_id",
        "usage_date",
        "data_download_gb",
        "data_upload_gb",
        "voice_minutes",
        "sms_count",
        capped_hours.alias("streaming_hours"),
        "total_session_count",
        numeric.amount(F.least(minutes, F.lit(MINUTES_PER_DAY))).alias("avg_session_minutes"),
        "international_minutes",
        "peak_usage_gb",
        "offpeak_usage_gb",
        numeric.amount(down + up, 4).alias("total_data_gb"),
        numeric.amount(voice + c("international_minutes")).alias("total_voice_minutes"),
        numeric.ratio(down + up, sessions).alias("avg_data_gb_per_session"),
        ((down >= 0) & (up >= 0) & (voice >= 0) & (sms >= 0) & (capped_hours >= 0)).alias(
            "dq_nonnegative_metrics"
        ),
        reconciles.alias("dq_peak_offpeak_reconciles"),
        text.first_match(
            [
                (c("usage_date").isNull(), "INVALID_DATE"),
                (c("usage_date") > today, "FUTURE_DATE_EXCLUDED"),
                ((hours > HOURS_PER_DAY) | (minutes > MINUTES_PER_DAY), "OUTLIER_CAPPED"),
                (~active, "NO_RECORDED_USAGE"),
                (~reconciles, "USAGE_COMPONENT_MISMATCH"),
            ],
            "VALID",
        ).alias("usage_dq_status"),
        active.alias("has_service_activity"),
        *lineage(),
    )
