"""Raw source tables: their columns, and how they are read."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_LOADED = "_airbyte_extracted_at timestamp, _airbyte_generation_id bigint"

# Columns by source. Dates may also arrive as text: give their type in the
# ``overrides`` of ``read_raw``; the models read either.
COLUMNS: dict[str, str] = {
    "crm_customers": """customer_id string, msisdn string, age int, gender string, city string, region string,
        postal_code string, marital_status string, senior_citizen int, customer_segment string,
        registration_date date, dependents int, number_of_dependents int, estimated_income_band string""",
    "subscriptions_contracts": """subscription_id string, customer_id string, status string, plan_name string,
        plan_tier string, contract_type string, contract_start_date date, contract_end_date date,
        plan_change_date date, previous_plan string, base_monthly_price decimal(18,2), phone_service int,
        multiple_lines int, internet_service int, online_security int, online_backup int, device_protection int,
        tech_support int, streaming_tv int, streaming_movies int, paperless_billing int""",
    "billing_invoices": """invoice_id string, customer_id string, subscription_id string, account_id string,
        issue_date date, due_date date, currency string, invoice_status string, base_charge decimal(18,2),
        service_charge decimal(18,2), equipment_charge decimal(18,2), extra_usage_charge decimal(18,2),
        discount decimal(18,2), tax decimal(18,2), total_amount decimal(18,2), previous_month_amount decimal(18,2),
        amount_change decimal(18,2), amount_change_pct decimal(18,4)""",
    "payments": """payment_id string, invoice_id string, customer_id string, payment_date date,
        payment_method string, payment_status string, amount_due decimal(18,2), amount_paid decimal(18,2),
        outstanding_balance decimal(18,2), days_late int, failed_attempts int, collection_action string""",
    "service_usage": """usage_id string, customer_id string, usage_date date, sms_count int,
        voice_minutes decimal(18,4), international_minutes decimal(18,4), data_upload_gb decimal(18,4),
        data_download_gb decimal(18,4), peak_usage_gb decimal(18,4), offpeak_usage_gb decimal(18,4),
        streaming_hours decimal(18,4), avg_session_minutes decimal(18,4), total_session_count int""",
    "network_quality": """event_id string, customer_id string, customer_ref string, device_id string,
        timestamp string, event_type string, technology string, network_node string, latency_ms decimal(18,2),
        jitter_ms decimal(18,2), packet_loss_pct decimal(18,4), signal_strength_dbm decimal(18,2),
        download_mbps decimal(18,2), upload_mbps decimal(18,2), outage_duration_seconds decimal(18,2),
        connection_dropped string, _ab_cdc_deleted_at string""",
    "support_tickets": """ticket_id string, customer_id string, status string, channel string, category string,
        reason string, priority string, agent_team string, created_at string, resolved_at string, reopened string,
        first_contact_resolution string, resolution_minutes string, interaction_count int,
        satisfaction_score decimal(18,2), _ab_cdc_deleted_at string""",
    "marketing_retention": """interaction_id string, customer_id string, campaign_id string, campaign_name string,
        channel string, offer_type string, contact_date date, response_date date, accepted boolean,
        retained_30d boolean, retained_60d boolean, retained_90d boolean, upgrade_offered boolean,
        equipment_upgrade boolean, discount_pct decimal(18,4), free_months int, campaign_cost decimal(18,2),
        estimated_customer_value decimal(18,2), retention_reason string""",
    "churn_labels": """customer_id string, churned int, churn_date date, churn_reason string,
        customer_status string, tenure_months_at_end int""",
    "macro_monthly": """year_month string, ipc_index decimal(18,4), desempleo_pct decimal(18,4),
        inflacion_mensual decimal(18,4), tipo_cambio_bob_usd decimal(18,6), shock_tarifa int""",
    "metas_retencion_region_mes": """target_id string, region string, year_month string, arpu_target_bob string,
        active_base_target string, retention_budget_bob string, churn_rate_target_pct string,
        retained_customers_target string, responsable_comercial string, comentario string,
        ultima_actualizacion string""",
    "xref_customer_id": "account_id string, customer_id string, source_crm string, source_billing string",
}

# How old a source may get before it is reported.
MAX_AGE: dict[str, dt.timedelta] = {
    **{name: dt.timedelta(hours=24) for name in COLUMNS},
    "macro_monthly": dt.timedelta(days=45),
    "metas_retencion_region_mes": dt.timedelta(days=45),
    "xref_customer_id": dt.timedelta(days=7),
}

ORDER_TABLES = ("orders", "lineitem")


def raw_schema(source: str, overrides: Mapping[str, str] | None = None) -> T.StructType:
    schema = T.StructType.fromDDL(f"{COLUMNS[source]}, {_LOADED}")
    kinds = overrides or {}
    return T.StructType(
        [T.StructField(f.name, T._parse_datatype_string(kinds[f.name]) if f.name in kinds else f.dataType) for f in schema]
    )


def read_raw(
    spark: SparkSession, source: str, root: str, fmt: str = "parquet", overrides: Mapping[str, str] | None = None
) -> DataFrame:
    """``<root>/<source>`` with the declared columns, so no file is opened to infer them."""
    reader = spark.read.format(fmt)
    if source not in ORDER_TABLES:
        reader = reader.schema(raw_schema(source, overrides))
    return reader.load(f"{root}/{source}")


def raw_tables(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """All raw tables below ``root``."""
    return {name: read_raw(spark, name, root, fmt) for name in (*COLUMNS, *ORDER_TABLES)}
