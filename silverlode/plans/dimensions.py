"""Gold dimensions, rebuilt in full by each run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.functions import text
from silverlode.functions.keys import surrogate_key
from silverlode.operators.latest import latest_per_key
from silverlode.plans.silver.subscription import SERVICES


def dim_customer(customer: DataFrame) -> DataFrame:
    """Current customers; no history is kept."""
    return customer.select(
        surrogate_key("customer_id").alias("customer_key"),
        surrogate_key("region").alias("region_key"),
        "customer_id",
        "age",
        "gender",
        "city",
        "region",
        "postal_code",
        "marital_status",
        "senior_citizen",
        "customer_segment",
        "registration_date",
        "has_dependents",
        "dependents_count",
        "estimated_income_band",
        F.col("source_extracted_at").alias("effective_from"),
        F.lit(True).alias("is_current"),
    )


def dim_subscription(subscription: DataFrame) -> DataFrame:
    return subscription.select(
        surrogate_key("subscription_id").alias("subscription_key"),
        surrogate_key("customer_id").alias("customer_key"),
        surrogate_key("plan_name", "plan_tier").alias("plan_key"),
        "subscription_id",
        "status",
        "contract_type",
        "contract_start_date",
        "contract_end_date",
        "plan_change_date",
        "previous_plan",
        "base_monthly_price",
        *SERVICES.values(),
        "source_raw_id",
        "source_extracted_at",
        "source_generation_id",
    )


def dim_plan(subscription: DataFrame) -> DataFrame:
    plans = subscription.select("plan_name", "plan_tier").distinct()
    return plans.select(surrogate_key("plan_name", "plan_tier").alias("plan_key"), "plan_name", "plan_tier")


def dim_region(customer: DataFrame) -> DataFrame:
    regions = customer.select(F.col("region").alias("region_name")).distinct()
    return regions.select(surrogate_key("region_name").alias("region_key"), "region_name")


def dim_campaign(marketing: DataFrame) -> DataFrame:
    """Newest name of each campaign."""
    c = F.col
    named = marketing.filter(c("campaign_id").isNotNull()).select(
        "campaign_id", "campaign_name", "source_extracted_at", "interaction_id"
    )
    newest = latest_per_key(
        named,
        ["campaign_id"],
        [c("source_extracted_at").desc_nulls_first(), c("campaign_name").asc(), c("interaction_id").asc()],
        total=True,
    )
    return newest.select(surrogate_key("campaign_id").alias("campaign_key"), "campaign_id", "campaign_name")


def dim_agent_team(support: DataFrame) -> DataFrame:
    teams = support.select(text.category(F.col("agent_team")).alias("agent_team_name")).distinct()
    return teams.select(surrogate_key("agent_team_name").alias("agent_team_key"), "agent_team_name")


def dim_network_node(network: DataFrame) -> DataFrame:
    nodes = network.select("network_node").distinct()
    return nodes.select(surrogate_key("network_node").alias("network_node_key"), "network_node")
