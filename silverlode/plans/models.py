"""All models by name, with the tables they read.

A ``Warehouse`` hands out tables: stored ones where there are any, otherwise
the model applied to its inputs. Nothing is computed until an action asks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from silverlode.operators.checks import Check
from silverlode.plans import analytic, bronze, dimensions, facts, marts
from silverlode.plans.silver.billing import clean_billing
from silverlode.plans.silver.churn import clean_churn
from silverlode.plans.silver.common import RESTORE
from silverlode.plans.silver.customer import clean_customer
from silverlode.plans.silver.macro import clean_macro
from silverlode.plans.silver.marketing import clean_marketing
from silverlode.plans.silver.network import clean_network
from silverlode.plans.silver.payment import clean_payment
from silverlode.plans.silver.subscription import clean_subscription
from silverlode.plans.silver.support import clean_support
from silverlode.plans.silver.target import clean_retention_target
from silverlode.plans.silver.usage import clean_usage
from silverlode.plans.silver.xref import clean_xref
from silverlode.sources.calendar import dim_date
from silverlode.sources.raw import COLUMNS


@dataclass(frozen=True)
class Model:
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    dated: bool = False  # takes the clock of the run
    deletable: bool = False  # takes what a deletion does


BRONZE = {f"stg_{source}": Model(bronze.replica, (source,)) for source in COLUMNS}
ORDER_STAGING = {
    "tpch_orders": Model(bronze.tpch_orders, ("orders",)),
    "tpch_lineitem": Model(bronze.tpch_lineitem, ("lineitem",)),
}
SILVER = {
    "int_customer_clean": Model(clean_customer, ("stg_crm_customers",), True),
    "int_subscription_clean": Model(clean_subscription, ("stg_subscriptions_contracts",), True),
    "int_billing_clean": Model(clean_billing, ("stg_billing_invoices",), True),
    "int_payment_clean": Model(clean_payment, ("stg_payments",), True),
    "int_usage_clean": Model(clean_usage, ("stg_service_usage",), True),
    "int_network_clean": Model(clean_network, ("stg_network_quality",), True, True),
    "int_support_clean": Model(clean_support, ("stg_support_tickets",), True, True),
    "int_marketing_clean": Model(clean_marketing, ("stg_marketing_retention",), True),
    "int_churn_clean": Model(clean_churn, ("stg_churn_labels", "int_customer_clean"), True),
    "int_macro_clean": Model(clean_macro, ("stg_macro_monthly",), True),
    "int_retention_target_clean": Model(clean_retention_target, ("stg_metas_retencion_region_mes",)),
    "int_xref_customer_clean": Model(clean_xref, ("stg_xref_customer_id",)),
}
_CONTRACTS = ("int_customer_clean", "int_subscription_clean", "int_churn_clean")
_FRICTION = (
    "int_billing_clean",
    "int_payment_clean",
    "int_usage_clean",
    "int_network_clean",
    "int_support_clean",
    "int_customer_clean",
)
ANALYTIC = {
    "int_r1_early_churn": Model(analytic.early_churn, _CONTRACTS, True),
    "int_r2_contract_opportunity": Model(analytic.contract_opportunity, _CONTRACTS, True),
    "int_r3_friction_monthly": Model(analytic.friction_monthly, _FRICTION),
    "int_r4_campaign_effectiveness": Model(
        analytic.campaign_effectiveness, ("int_marketing_clean", "int_customer_clean")
    ),
    "int_r5_ml_features": Model(
        analytic.churn_features,
        (
            "int_r3_friction_monthly",
            "int_customer_clean",
            "int_subscription_clean",
            "int_macro_clean",
            "int_churn_clean",
        ),
    ),
}
DIMENSIONS = {
    "dim_customer": Model(dimensions.dim_customer, ("int_customer_clean",)),
    "dim_subscription": Model(dimensions.dim_subscription, ("int_subscription_clean",)),
    "dim_plan": Model(dimensions.dim_plan, ("int_subscription_clean",)),
    "dim_region": Model(dimensions.dim_region, ("int_customer_clean",)),
    "dim_campaign": Model(dimensions.dim_campaign, ("int_marketing_clean",)),
    "dim_agent_team": Model(dimensions.dim_agent_team, ("int_support_clean",)),
    "dim_network_node": Model(dimensions.dim_network_node, ("int_network_clean",)),
}
CALENDAR = "dim_date"
FACTS = {
    "fact_billing": Model(
        facts.fact_billing, ("int_billing_clean", "int_subscription_clean", "int_customer_clean")
    ),
    "fact_payment": Model(facts.fact_payment, ("int_payment_clean",)),
    "fact_usage_snapshot": Model(facts.fact_usage_snapshot, ("int_usage_clean",)),
    "fact_network_event": Model(facts.fact_network_event, ("int_network_clean", "int_customer_clean")),
    "fact_support_ticket": Model(facts.fact_support_ticket, ("int_support_clean", "int_customer_clean")),
    "fact_marketing_interaction": Model(
        facts.fact_marketing_interaction, ("int_marketing_clean", "int_customer_clean")
    ),
    "fact_churn_event": Model(facts.fact_churn_event, ("int_churn_clean", "int_customer_clean")),
    "fact_subscription_event": Model(facts.fact_subscription_event, ("int_subscription_clean",)),
    "fact_macro_monthly": Model(facts.fact_macro_monthly, ("int_macro_clean",)),
    "fact_retention_target_monthly": Model(
        facts.fact_retention_target_monthly, ("int_retention_target_clean",)
    ),
    "fact_customer_month_snapshot": Model(
        facts.fact_customer_month_snapshot, ("int_subscription_clean",), True
    ),
}
MARTS = {
    "mart_r1_churn_early": Model(marts.mart_churn_early, ("int_r1_early_churn",)),
    "mart_r2_contract_opportunity": Model(marts.mart_contract_opportunity, ("int_r2_contract_opportunity",)),
    "mart_r3_friction": Model(marts.mart_friction, ("int_r3_friction_monthly",)),
    "mart_r4_campaigns": Model(marts.mart_campaigns, ("int_r4_campaign_effectiveness",)),
    "mart_r5_crispdm_dataset": Model(marts.mart_crispdm_dataset, ("int_r5_ml_features",)),
}
ORDER_MART = {"order_item": Model(marts.order_item, ("tpch_orders", "tpch_lineitem"))}

MODELS: dict[str, Model] = {
    **BRONZE,
    **ORDER_STAGING,
    **SILVER,
    **ANALYTIC,
    **DIMENSIONS,
    **FACTS,
    **MARTS,
    **ORDER_MART,
}


class Warehouse:
    """Tables by name, built from raw tables on demand."""

    def __init__(
        self,
        spark: SparkSession,
        raw: Callable[[str], DataFrame],
        as_of: dt.date | None = None,
        stored: Mapping[str, DataFrame] | None = None,
        deletes: str = RESTORE,
    ):
        self.spark = spark
        self.as_of = as_of
        self.deletes = deletes
        # Failures of checks that were counted while a stored table was written.
        self.counted: dict[Check, int] = {}
        self._raw = raw
        self._tables: dict[str, DataFrame] = dict(stored or {})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._build(name)
        return self._tables[name]

    def store(self, name: str, table: DataFrame) -> None:
        """From now on ``name`` is this table."""
        self._tables[name] = table

    def _build(self, name: str) -> DataFrame:
        if name == CALENDAR:
            return dim_date(self.spark, self.as_of)
        if name not in MODELS:
            return self._raw(name)
        model = MODELS[name]
        options = {"as_of": self.as_of} if model.dated else {}
        if model.deletable:
            options["deletes"] = self.deletes
        return model.build(*(self[i] for i in model.inputs), **options)

    def create_views(self) -> None:
        """Register bronze, silver and analytic models as temporary views."""
        for name in (*BRONZE, *SILVER, *ANALYTIC):
            self[name].createOrReplaceTempView(name)
