"""Support tickets: classified, with resolution checks and service levels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.functions import dates, numeric, parsing, text
from silverlode.plans.silver.common import RESTORE, extracted_at, keep_if, lineage, newest_records, not_before

# Spellings of each status.
STATUSES = {
    "CLOSED": ("CLOSED", "CERRADO"),
    "RESOLVED": ("RESOLVED", "RESUELTO"),
    "OPEN": ("OPEN", "ABIERTO"),
    "PENDING": ("PENDING", "PENDIENTE"),
}
# Words in the category and in the reason that decide the class;
# the first class that fits is taken.
CLASSES = {
    "RETENTION_RISK": {"category": ("CANCEL", "CHURN"), "reason": ("CANCEL", "CHURN")},
    "BILLING": {"category": ("BILL",), "reason": ("PAY",)},
    "NETWORK": {"category": ("NETWORK", "OUTAGE"), "reason": ("SIGNAL",)},
    "TECHNICAL": {"category": ("TECH",)},
}
# Minutes allowed to a priority, and to any ticket.
SLA_MINUTES = {("CRITICAL", "URGENT"): 240, ("HIGH",): 480}
SLA_MINUTES_ANY = 1440
BEST_SCORE = 5


def clean_support(raw: DataFrame, as_of: dt.date | None = None, deletes: str = RESTORE) -> DataFrame:
    """Deleted versions are left out first, so an older live version comes back; with ``deletes="tombstone"`` the
    newest version decides, and a deleted record stays away.
    """
    today = dates.day(as_of)
    c = F.col
    newest = newest_records(raw, "support_tickets", deletes)
    unreadable_as_false = F.lit(False)
    staged = newest.select(
        F.trim("ticket_id").alias("ticket_id"),
        F.trim("customer_id").alias("customer_id"),
        parsing.safe_timestamp(raw, "created_at").alias("created_timestamp"),
        parsing.safe_timestamp(raw, "resolved_at").alias("resolved_timestamp_source"),
        text.map_codes(c("status"), STATUSES).alias("status"),
        *[text.category(c(n)).alias(n) for n in ("channel", "category", "priority", "reason", "agent_team")],
        F.coalesce(parsing.safe_boolean(raw, "reopened"), unreadable_as_false).alias("reopened"),
        numeric.positive_whole(c("interaction_count")).alias("interaction_count"),
        # Unreadable minutes count as 0, so such tickets are within any service level.
        numeric.positive_amount(parsing.safe_decimal(c("resolution_minutes").cast("string"), 38, 0)).alias(
            "resolution_minutes"
        ),
        numeric.amount(c("satisfaction_score")).alias("satisfaction_score"),
        F.coalesce(parsing.safe_boolean(raw, "first_contact_resolution"), unreadable_as_false).alias(
            "first_contact_resolution"
        ),
        extracted_at(),
    )
    created, resolved_source = c("created_timestamp"), c("resolved_timestamp_source")
    resolved_ok = not_before(resolved_source, created)
    resolved = keep_if(resolved_ok, resolved_source)
    minutes, score = c("resolution_minutes"), c("satisfaction_score")
    score_ok = score.between(0, BEST_SCORE)
    created_day = created.cast("date")
    return staged.filter(created_day <= today).select(
        "ticket_id",
        "customer_id",
        F.lit(None).cast("string").alias("contact_id"),
        "created_timestamp",
        resolved.alias("resolved_timestamp"),
        "resolved_timestamp_source",
        "status",
        "channel",
        "category",
        "priority",
        "reason",
        "agent_team",
        text.first_match(
            [
                (text.contains_any((c(n), words) for n, words in tests.items()), label)
                for label, tests in CLASSES.items()
            ],
            "GENERAL",
        ).alias("classification"),
        "reopened",
        "interaction_count",
        numeric.amount(
            F.coalesce(minutes, keep_if(resolved_ok, dates.minutes_between(created, resolved_source)))
        ).alias("resolution_minutes_num"),
        keep_if(score_ok, score).alias("satisfaction_score"),
        "first_contact_resolution",
        text.first_match([(score.isNull(), "MISSING"), (score_ok, "VALID")], "OUT_OF_RANGE_TO_NULL").alias(
            "satisfaction_dq_status"
        ),
        resolved_ok.alias("dq_valid_resolution_timestamp"),
        (minutes.isNull() | (minutes >= 0)).alias("dq_valid_resolution_minutes"),
        text.first_match(
            [
                (created.isNull(), "INVALID_CREATED_TIMESTAMP"),
                (created_day > today, "FUTURE_TICKET_EXCLUDED"),
                (resolved_source < created, "INVALID_RESOLUTION_TO_NULL"),
                (minutes < 0, "NEGATIVE_DURATION_CORRECTED"),
                (~score_ok, "SATISFACTION_OUTLIER_TO_NULL"),
                (c("status").isin("RESOLVED", "CLOSED") & resolved.isNull(), "CLOSED_WITHOUT_VALID_RESOLUTION"),
            ],
            "VALID",
        ).alias("support_dq_status"),
        text.first_match(
            [
                (resolved.isNull(), "OPEN_OR_UNRESOLVED"),
                *[
                    (c("priority").isin(*priorities) & (minutes > limit), "SLA_BREACH")
                    for priorities, limit in SLA_MINUTES.items()
                ],
                (minutes > SLA_MINUTES_ANY, "SLA_BREACH"),
            ],
            "WITHIN_SLA",
        ).alias("sla_status"),
        *lineage(),
    )
