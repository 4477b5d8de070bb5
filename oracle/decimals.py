"""Columns that are decimals in the expected results; they are compared as doubles."""

from __future__ import annotations

USAGE_FACT = ("data_download_gb", "data_upload_gb", "voice_minutes", "streaming_hours", "avg_session_minutes",
 "international_minutes", "peak_usage_gb", "offpeak_usage_gb")
USAGE = ("data_download_gb", "data_upload_gb", "voice_minutes", "streaming_hours", "avg_session_minutes",
 "international_minutes", "peak_usage_gb", "offpeak_usage_gb", "total_data_gb",
 "total_voice_minutes")
NETWORK = ("latency_ms", "jitter_ms", "packet_loss_pct", "download_mbps", "upload_mbps",
 "signal_strength_dbm", "outage_duration_seconds")
FRICTION = ("billed_amount", "billing_amount_change", "outstanding_balance", "total_data_gb", "voice_minutes",
 "outage_seconds")
FEATURES = ("billed_amount", "billing_amount_change", "outstanding_balance", "total_data_gb", "voice_minutes",
 "outage_seconds", "base_monthly_price")
PRICE = ("base_monthly_price",)
TICKET = ("resolution_minutes_num", "satisfaction_score")
CAMPAIGN = ("discount_pct_num", "campaign_cost_num", "estimated_customer_value_num")
TARGET = ("arpu_target_bob_num", "retention_budget_bob_num", "churn_rate_target_pct_num")
DISCOUNT = ("item_discount_amount",)

DECIMALS: dict[str, tuple[str, ...]] = {
    "int_subscription_clean": PRICE,
    "int_billing_clean": ("base_charge", "service_charge", "equipment_charge", "extra_usage_charge", "tax", "discount",
     "total_amount_source", "total_amount_recalculated", "amount_variance", "previous_month_amount",
     "amount_change", "amount_change_pct"),
    "int_payment_clean": ("amount_due", "amount_paid", "outstanding_balance", "outstanding_balance_source",
     "outstanding_balance_variance"),
    "int_usage_clean": USAGE,
    "int_network_clean": NETWORK,
    "int_support_clean": TICKET,
    "int_marketing_clean": CAMPAIGN,
    "int_retention_target_clean": TARGET,
    "int_r2_contract_opportunity": PRICE,
    "int_r3_friction_monthly": FRICTION,
    "int_r4_campaign_effectiveness": ("discount_pct", "campaign_cost", "estimated_customer_value", "estimated_net_value"),
    "int_r5_ml_features": FEATURES,
    "dim_subscription": PRICE,
    "fact_billing": ("base_charge", "service_charge", "equipment_charge", "extra_usage_charge", "tax", "discount",
     "total_amount_source", "total_amount_recalculated", "previous_month_amount", "amount_change",
     "amount_change_pct"),
    "fact_payment": ("amount_due", "amount_paid", "outstanding_balance"),
    "fact_usage_snapshot": USAGE_FACT,
    "fact_network_event": NETWORK,
    "fact_support_ticket": TICKET,
    "fact_marketing_interaction": CAMPAIGN,
    "fact_subscription_event": PRICE,
    "fact_retention_target_monthly": TARGET,
    "fact_customer_month_snapshot": PRICE,
    "mart_r2_contract_opportunity": PRICE,
    "mart_r3_friction": FRICTION,
    "mart_r4_campaigns": ("campaign_cost", "estimated_net_value"),
    "mart_r5_crispdm_dataset": FEATURES,
    "order_item": DISCOUNT,
    "incremental_slice": USAGE_FACT,
    "upsert": USAGE_FACT,
    "upsert_files": USAGE_FACT,
    "dq_relationships": USAGE,
    "dq_singular": DISCOUNT,
    "stg_subscriptions_contracts": PRICE,
    "stg_billing_invoices": ("base_charge", "service_charge", "equipment_charge", "extra_usage_charge", "discount", "tax",
     "total_amount", "previous_month_amount", "amount_change", "amount_change_pct"),
    "stg_payments": ("amount_due", "amount_paid", "outstanding_balance"),
    "stg_service_usage": ("voice_minutes", "international_minutes", "data_upload_gb", "data_download_gb", "peak_usage_gb",
     "offpeak_usage_gb", "streaming_hours", "avg_session_minutes"),
    "stg_network_quality": ("latency_ms", "jitter_ms", "packet_loss_pct", "signal_strength_dbm", "download_mbps",
     "upload_mbps", "outage_duration_seconds"),
    "stg_support_tickets": ("satisfaction_score",),
    "stg_marketing_retention": ("discount_pct", "campaign_cost", "estimated_customer_value"),
    "stg_macro_monthly": ("ipc_index", "desempleo_pct", "inflacion_mensual", "tipo_cambio_bob_usd"),
}

# Queries that return a model's columns.
for _name, _model in {
    "text_dates": "int_payment_clean",
    "sync_columns_files": "fact_billing",
    "snapshot_files": "fact_customer_month_snapshot",
    "lookback_files": "fact_usage_snapshot",
    "deletes_tombstone": "int_support_clean",
    "deletes_tombstone_files": "fact_support_ticket",
    "friction_by_changes": "int_r3_friction_monthly",
    "contracts_by_changes": "int_subscription_clean",
    "mart_r1_loaded": "mart_r1_churn_early",
    "order_item_clustered": "order_item",
}.items():
    if _model in DECIMALS:
        DECIMALS[_name] = DECIMALS[_model]
