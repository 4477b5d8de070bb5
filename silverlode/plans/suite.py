"""The checks of the models."""

from __future__ import annotations

from silverlode.operators.checks import Check


def _key(model: str, *columns: str) -> list[Check]:
    return [Check(model, c, kind) for c in columns for kind in ("not_null", "unique")]


def _filled(model: str, *columns: str) -> list[Check]:
    return [Check(model, c, "not_null") for c in columns]


def _known_customer(model: str) -> Check:
    return Check(model, "customer_id", "relationships", ("customer_id",), "int_customer_clean")


# Which columns are keys, which are required, and the allowed values.
CHECKS: list[Check] = [
    *_key("int_customer_clean", "customer_id"),
    *_filled("int_customer_clean", "age", "registration_date"),
    Check("int_customer_clean", "age", "between", (18, 120)),
    Check(
        "int_customer_clean",
        "dependents_dq_status",
        "accepted_values",
        ("VALID", "IMPUTED_ZERO", "CORRECTED_TO_ZERO", "BOOLEAN_ALIGNED_TO_COUNT"),
    ),
    *_key("int_churn_clean", "customer_id"),
    _known_customer("int_churn_clean"),
    *_filled("int_churn_clean", "churn_date"),
    *_key("int_subscription_clean", "subscription_id"),
    *_filled("int_subscription_clean", "customer_id"),
    _known_customer("int_subscription_clean"),
    *_key("int_billing_clean", "invoice_id"),
    *_key("int_payment_clean", "payment_id"),
    *_key("int_usage_clean", "usage_id"),
    *_key("int_network_clean", "event_id"),
    *_key("int_support_clean", "ticket_id"),
    Check("int_support_clean", "satisfaction_score", "between", (0, 5)),
    *_key("int_marketing_clean", "interaction_id"),
    *_key("int_macro_clean", "year_month"),
    *_key("int_retention_target_clean", "target_id"),
    *_filled("int_xref_customer_clean", "account_id", "customer_id"),
    *_key("dim_customer", "customer_key", "customer_id"),
    *_key("dim_subscription", "subscription_key", "subscription_id"),
    *_key("dim_date", "date_key"),
    *_key("dim_region", "region_key"),
    *_key("dim_plan", "plan_key"),
    *_key("dim_agent_team", "agent_team_key"),
    *_key("dim_campaign", "campaign_key"),
    *_key("dim_network_node", "network_node_key"),
    *_key("fact_billing", "billing_key"),
    *_filled("fact_billing", "invoice_id"),
    *_key("fact_payment", "payment_key"),
    *_key("fact_usage_snapshot", "usage_key"),
    *_key("fact_network_event", "network_event_key"),
    *_key("fact_support_ticket", "support_ticket_key"),
    *_key("fact_marketing_interaction", "marketing_interaction_key"),
    *_key("fact_churn_event", "churn_event_key"),
    *_filled("fact_churn_event", "churn_date_key"),
    *_key("fact_macro_monthly", "macro_month_key"),
    *_key("fact_retention_target_monthly", "retention_target_key"),
    *_key("fact_subscription_event", "subscription_event_key"),
    *_key("fact_customer_month_snapshot", "customer_month_key"),
    *_filled("fact_customer_month_snapshot", "month_date_key"),
    *_filled("int_r5_ml_features", "observation_date", "label_churn_next_90d"),
    Check("int_r5_ml_features", "label_churn_next_90d", "accepted_values", (0, 1)),
    *_filled("order_item", "order_key", "line_number", "item_discount_amount"),
]
