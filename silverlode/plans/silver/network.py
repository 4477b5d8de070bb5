"""Network quality events: capped metrics and a quality band."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.functions import dates, numeric, parsing, text
from silverlode.plans.silver.common import RESTORE, extracted_at, keep_if, lineage, newest_records

# Caps, physical signal range, and the limits of the bands.
LATENCY_CAP, JITTER_CAP, LOSS_CAP = 10000, 5000, 100
WEAKEST_SIGNAL, STRONGEST_SIGNAL = -150, -10
EXTREME_LATENCY, EXTREME_JITTER, EXTREME_OUTAGE = 2000, 1000, 86400
DEGRADED_LOSS, DEGRADED_LATENCY, DEGRADED_JITTER = 5, 200, 50
WEAK_SIGNAL = -110


def clean_network(raw: DataFrame, as_of: dt.date | None = None, deletes: str = RESTORE) -> DataFrame:
    """Deleted versions are left out first, so an older live version comes back; with ``deletes="tombstone"`` the
    newest version decides, and a deleted record stays away.
    """
    today = dates.day(as_of)
    c = F.col
    newest = newest_records(raw, "network_quality", deletes)
    staged = newest.select(
        *[F.trim(i).alias(i) for i in ("event_id", "customer_id", "device_id")],
        parsing.safe_timestamp(raw, "timestamp").alias("event_timestamp"),
        text.category(c("event_type")).alias("event_type_norm"),
        text.category(c("technology")).alias("technology_norm"),
        text.category(c("network_node")).alias("network_node"),
        *[
            numeric.amount_or_zero(c(m), 4 if m == "packet_loss_pct" else 2).alias(m)
            for m in (
                "latency_ms",
                "jitter_ms",
                "packet_loss_pct",
                "download_mbps",
                "upload_mbps",
                # A missing signal counts as 0 dBm here, hence as out of range below.
                "signal_strength_dbm",
                "outage_duration_seconds",
            )
        ],
        F.coalesce(parsing.safe_boolean(raw, "connection_dropped"), F.lit(False)).alias("connection_dropped_bool"),
        extracted_at(),
    )
    latency, jitter, loss = c("latency_ms"), c("jitter_ms"), c("packet_loss_pct")
    down, up, signal, outage = (
        c(m) for m in ("download_mbps", "upload_mbps", "signal_strength_dbm", "outage_duration_seconds")
    )
    capped_latency = numeric.amount(numeric.clamp(latency, LATENCY_CAP))
    capped_jitter = numeric.amount(numeric.clamp(jitter, JITTER_CAP))
    capped_loss = numeric.amount(numeric.clamp(loss, LOSS_CAP), 4)
    valid_outage = numeric.positive_amount(outage)
    signal_ok = signal.between(WEAKEST_SIGNAL, STRONGEST_SIGNAL)
    valid_signal = keep_if(signal_ok, signal)
    event_day = c("event_timestamp").cast("date")
    return staged.filter(event_day <= today).select(
        "event_id",
        "customer_id",
        "device_id",
        "event_timestamp",
        "event_type_norm",
        "technology_norm",
        "network_node",
        capped_latency.alias("latency_ms"),
        capped_jitter.alias("jitter_ms"),
        capped_loss.alias("packet_loss_pct"),
        numeric.positive_amount(down).alias("download_mbps"),
        numeric.positive_amount(up).alias("upload_mbps"),
        valid_signal.alias("signal_strength_dbm"),
        valid_outage.alias("outage_duration_seconds"),
        "connection_dropped_bool",
        text.first_match(
            [
                (c("event_timestamp").isNull(), "INVALID_TIMESTAMP"),
                (event_day > today, "FUTURE_EVENT_EXCLUDED"),
                (
                    (latency < 0) | (jitter < 0) | (down < 0) | (up < 0) | (outage < 0),
                    "NEGATIVE_METRIC_CORRECTED",
                ),
                (~loss.between(0, LOSS_CAP), "PACKET_LOSS_CAPPED"),
                (signal.isNull() | ~signal_ok, "INVALID_SIGNAL_TO_NULL"),
                (
                    (latency > EXTREME_LATENCY) | (jitter > EXTREME_JITTER) | (outage > EXTREME_OUTAGE),
                    "EXTREME_OUTLIER_CAPPED",
                ),
            ],
            "VALID",
        ).alias("network_dq_status"),
        text.first_match(
            [
                (c("connection_dropped_bool") | (valid_outage > 0), "OUTAGE_OR_DROP"),
                (
                    (capped_loss >= DEGRADED_LOSS)
                    | (capped_latency >= DEGRADED_LATENCY)
                    | (capped_jitter >= DEGRADED_JITTER),
                    "DEGRADED",
                ),
                (valid_signal.isNull() | (valid_signal < WEAK_SIGNAL), "WEAK_SIGNAL"),
            ],
            "NORMAL",
        ).alias("network_quality_band"),
        (latency.isNull() | (latency >= 0)).alias("dq_valid_latency"),
        (loss.isNull() | loss.between(0, LOSS_CAP)).alias("dq_valid_packet_loss"),
        (signal.isNull() | signal_ok).alias("dq_valid_signal"),
        *lineage(),
    )
