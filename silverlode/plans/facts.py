"""Gold facts. Each is kept up to date by merging new rows on its key."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.functions import dates, numeric
from silverlode.functions.keys import surrogate_key
from silverlode.operators.latest import latest_per_key
from silverlode.operators.months import months_covered
from silverlode.sources.calendar import FIRST_DAY, last_calendar_day

ORIGIN = ("source_raw_id", "source_extracted_at", "source_generation_id")
# Fixed value: class of the columns a model may use as features.
FEATURE_CLASS = "PRE_OUTCOME_FEATURE"


def _key(name: str, *parts: Column | str) -> Column:
    return surrogate_key(*(parts or (name.removesuffix("_key") + "_id",))).alias(name)


def _one(name: str) -> Column:
    return F.lit(1).alias(name)


def _count(test: Column, name: str) -> Column:
    """1 where the test holds, else 0."""
    return F.when(test, 1).otherwise(0).alias(name)


def _regions(customer: DataFrame) -> DataFrame:
    return customer.select("customer_id", "region")


def fact_billing(billing: DataFrame, subscription: DataFrame, customer: DataFrame) -> DataFrame:
    c = F.col
    plans = subscription.select("subscription_id", "plan_name", "plan_tier")
    return (
        billing.join(plans, "subscription_id", "left")
        .join(_regions(customer), "customer_id", "left")
        .select(
            _key("billing_key", "invoice_id"),
            _key("customer_key"),
            _key("subscription_key"),
            _key("plan_key", "plan_name", "plan_tier"),
            _key("region_key", "region"),
            dates.date_key(c("issue_date")).alias("issue_date_key"),
            dates.date_key(c("due_date")).alias("due_date_key"),
            "invoice_id",
            "account_id",
            "billing_period",
            "invoice_status",
            "currency",
            "base_charge",
            "service_charge",
            "equipment_charge",
            "extra_usage_charge",
            "tax",
            "discount",
            "total_amount_source",
            "total_amount_recalculated",
            # Rounded to whole units, unlike the silver column.
            numeric.whole(c("amount_variance")).alias("amount_variance"),
            "previous_month_amount",
            "amount_change",
            "amount_change_pct",
            _one("invoice_count"),
            "dq_valid_dates",
            "dq_nonnegative_total",
            "dq_total_match",
            *ORIGIN,
        )
    )


def fact_payment(payment: DataFrame) -> DataFrame:
    c = F.col
    friction = (c("failed_attempts") > 0) | (c("days_late") > 0) | (c("outstanding_balance") > 0)
    return payment.select(
        _key("payment_key"),
        _key("customer_key"),
        "payment_id",
        "invoice_id",
        "payment_date",
        "payment_method",
        "payment_status",
        "collection_action",
        "amount_due",
        "amount_paid",
        "outstanding_balance",
        "days_late",
        "failed_attempts",
        _count(friction, "payment_friction_count"),
        *ORIGIN,
    )


def fact_usage_snapshot(usage: DataFrame) -> DataFrame:
    return usage.select(
        _key("usage_key"),
        _key("customer_key"),
        dates.date_key(F.col("usage_date")).alias("usage_date_key"),
        "usage_id",
        "data_download_gb",
        "data_upload_gb",
        "voice_minutes",
        "sms_count",
        "streaming_hours",
        "total_session_count",
        "avg_session_minutes",
        "international_minutes",
        "peak_usage_gb",
        "offpeak_usage_gb",
        _one("usage_snapshot_count"),
        "dq_nonnegative_metrics",
        "usage_dq_status",
        *ORIGIN,
    )


def fact_network_event(network: DataFrame, customer: DataFrame) -> DataFrame:
    c = F.col
    return network.join(_regions(customer), "customer_id", "left").select(
        _key("network_event_key", "event_id"),
        _key("customer_key"),
        _key("region_key", "region"),
        _key("network_node_key", "network_node"),
        dates.date_key(c("event_timestamp")).alias("event_date_key"),
        "event_id",
        "device_id",
        "event_timestamp",
        "event_type_norm",
        "technology_norm",
        "latency_ms",
        "jitter_ms",
        "packet_loss_pct",
        "download_mbps",
        "upload_mbps",
        "signal_strength_dbm",
        "outage_duration_seconds",
        "connection_dropped_bool",
        _count(c("connection_dropped_bool"), "connection_drop_count"),
        _one("network_event_count"),
        "network_dq_status",
        "source_is_deleted",
        F.lit(FEATURE_CLASS).alias("ml_field_class"),
        *ORIGIN,
    )


def fact_support_ticket(support: DataFrame, customer: DataFrame) -> DataFrame:
    c = F.col
    return support.join(_regions(customer), "customer_id", "left").select(
        _key("support_ticket_key", "ticket_id"),
        _key("customer_key"),
        _key("region_key", "region"),
        _key("agent_team_key", F.coalesce(F.nullif(c("agent_team"), F.lit("")), F.lit("UNKNOWN"))),
        dates.date_key(c("created_timestamp")).alias("created_date_key"),
        "ticket_id",
        "contact_id",
        "created_timestamp",
        "resolved_timestamp",
        "status",
        "channel",
        "category",
        "priority",
        "reason",
        "classification",
        "reopened",
        "interaction_count",
        "resolution_minutes_num",
        "satisfaction_score",
        "first_contact_resolution",
        _count(c("first_contact_resolution"), "first_contact_resolution_count"),
        _count(c("reopened"), "reopened_count"),
        _one("ticket_count"),
        "satisfaction_dq_status",
        "dq_valid_resolution_minutes",
        "source_is_deleted",
        F.lit(FEATURE_CLASS).alias("ml_field_class"),
        *ORIGIN,
    )


def fact_marketing_interaction(marketing: DataFrame, customer: DataFrame) -> DataFrame:
    c = F.col
    return marketing.join(_regions(customer), "customer_id", "left").select(
        _key("marketing_interaction_key", "interaction_id"),
        _key("customer_key"),
        _key("region_key", "region"),
        F.when(c("campaign_id").isNotNull(), surrogate_key("campaign_id")).alias("campaign_key"),
        dates.date_key(c("contact_date_parsed")).alias("contact_date_key"),
        "interaction_id",
        "contact_date_parsed",
        "response_date_parsed",
        "channel_norm",
        "offer_type_norm",
        "accepted_bool",
        "upgrade_offered",
        "equipment_upgrade",
        "discount_pct_num",
        "free_months_num",
        "campaign_cost_num",
        "estimated_customer_value_num",
        "retained_30d",
        "retained_60d",
        "retained_90d",
        "retention_reason",
        _count(c("accepted_bool"), "accepted_count"),
        _one("contact_count"),
        "dq_valid_discount",
        "dq_valid_response_date",
        "has_post_outcome_data",
        *ORIGIN,
    )


def fact_churn_event(churn: DataFrame, customer: DataFrame) -> DataFrame:
    """The date is part of the key: a corrected date adds a row, the old one stays."""
    return churn.join(_regions(customer), "customer_id", "left").select(
        _key("churn_event_key", "customer_id", "churn_date"),
        _key("customer_key"),
        _key("region_key", "region"),
        dates.date_key(F.col("churn_date")).alias("churn_date_key"),
        "customer_id",
        "tenure_months_at_end",
        _one("churn_event_count"),
        "churn_reason",
        "customer_status",
        "churned_field_class",
        "churn_detail_field_class",
        *ORIGIN,
    )


def fact_subscription_event(subscription: DataFrame) -> DataFrame:
    """The start is part of the key: a corrected start adds a row, the old one stays."""
    c = F.col
    return subscription.select(
        _key("subscription_event_key", "subscription_id", "contract_start_date"),
        _key("subscription_key"),
        _key("customer_key"),
        _key("plan_key", "plan_name", "plan_tier"),
        dates.date_key(c("contract_start_date")).alias("start_date_key"),
        "subscription_id",
        "status",
        "contract_type",
        "base_monthly_price",
        _count(c("plan_change_date").isNotNull(), "plan_change_count"),
        _one("subscription_event_count"),
        "dq_valid_contract_dates",
        "dq_valid_plan_change_date",
        *ORIGIN,
    )


def fact_macro_monthly(macro: DataFrame) -> DataFrame:
    return macro.select(
        _key("macro_month_key", "year_month"),
        dates.date_key(F.col("month_start")).alias("month_date_key"),
        "year_month",
        "ipc_index",
        "desempleo_pct",
        "inflacion_mensual",
        "tipo_cambio_bob_usd",
        "shock_tarifa",
        "dq_valid_year_month",
        *ORIGIN,
    )


def fact_retention_target_monthly(target: DataFrame) -> DataFrame:
    return target.select(
        _key("retention_target_key", "target_id"),
        _key("region_key", "region"),
        dates.date_key(F.col("month_start")).alias("month_date_key"),
        "target_id",
        "year_month",
        "arpu_target_bob_num",
        "active_base_target_num",
        "retention_budget_bob_num",
        "churn_rate_target_pct_num",
        "retained_customers_target_num",
        "responsable_comercial",
        "ultima_actualizacion_ts",
        "comentario",
        "dq_valid_year_month",
        "arpu_target_dq_status",
        "churn_target_dq_status",
        *ORIGIN,
    )


def fact_customer_month_snapshot(
    subscription: DataFrame, as_of: dt.date | None = None, earliest: Column | None = None
) -> DataFrame:
    """The newest contract of each customer in each month it runs, up to the run.

    ``earliest`` is the first month wanted, by contract; it has to be the same for all contracts of a customer.
    """
    c = F.col
    today = dates.day(as_of)
    first = F.lit(FIRST_DAY) if earliest is None else F.greatest(F.lit(FIRST_DAY), earliest)
    contracts = subscription.select(
        "customer_id",
        "subscription_id",
        "plan_name",
        "plan_tier",
        "contract_type",
        "base_monthly_price",
        "contract_start_date",
        "contract_end_date",
        "status",
        first.alias("first_month"),
    )
    newest_first = [c("contract_start_date").desc_nulls_first(), c("subscription_id").desc_nulls_first()]
    start, end = c("contract_start_date"), F.coalesce(c("contract_end_date"), today)
    # Of contracts that run from the same month to the same month only the newest counts. That bounds what a customer has,
    # so contracts can meet by customer first, and the many rows of their months do not move.
    spans = [dates.month_start(start).alias("__from"), dates.month_start(end).alias("__to")]
    contracts = latest_per_key(contracts.select("*", *spans), ["customer_id", "__from", "__to"], newest_first, total=True)
    # As many parts as shuffles have: their size before the months says little about that afterwards.
    parts = int(contracts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    running = months_covered(
        contracts.drop("__from", "__to").repartition(parts, "customer_id"),
        start,
        end,
        c("first_month"),
        last_calendar_day(as_of),
    )
    newest = latest_per_key(running, ["customer_id", "month_start"], newest_first, total=True)
    month_end = F.last_day("month_start")
    active = (c("status") == "ACTIVE") & (c("contract_end_date").isNull() | (c("contract_end_date") > month_end))
    return newest.select(
        _key("customer_month_key", "customer_id", "month_start"),
        _key("customer_key"),
        _key("subscription_key"),
        _key("plan_key", "plan_name", "plan_tier"),
        dates.date_key(c("month_start")).alias("month_date_key"),
        dates.month_key(c("month_start")).alias("year_month"),
        "month_start",
        month_end.alias("month_end"),
        "contract_type",
        "base_monthly_price",
        F.greatest(dates.months_between(c("contract_start_date"), month_end), F.lit(0)).alias(
            "tenure_months_at_month_end"
        ),
        _count(active, "active_at_month_end_count"),
    )
