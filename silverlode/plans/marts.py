"""Decision marts, rebuilt in full by each run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.functions import numeric, text

# The offer made for each priority.
ACTIONS = {"HIGH": "OFFER_TWO_YEAR", "MEDIUM": "OFFER_ONE_YEAR", "LOW": "NURTURE"}


def mart_churn_early(early: DataFrame) -> DataFrame:
    """Early churn per region and segment.

    The rate divides churned contracts by customers, so a customer with two
    contracts counts twice above and once below; it can pass 100.
    """
    churned = F.count_if(F.col("churned") == 1)
    customers = F.countDistinct("customer_id")
    return early.groupBy("region", "customer_segment").agg(
        customers.alias("customers_first_12_months"),
        churned.alias("churned_customers"),
        numeric.percentage(churned, customers).alias("churn_rate_pct"),
        F.avg("tenure_months_at_end").alias("avg_tenure_months"),
    )


def mart_contract_opportunity(opportunity: DataFrame) -> DataFrame:
    priority = F.col("migration_priority")
    action = text.first_match([(priority == p, offer) for p, offer in ACTIONS.items()], "EXCLUDE")
    return opportunity.select("*", action.alias("recommended_action"))


def mart_friction(friction: DataFrame) -> DataFrame:
    """Adds how many of four kinds of friction a customer-month shows."""
    c = F.col
    kinds = [
        c("billing_amount_change") > 0,
        c("failed_payment_attempts") > 0,
        (c("dropped_connections") > 0) | (c("outage_seconds") > 0),
        c("ticket_count") > 0,
    ]
    return friction.select("*", reduce(lambda a, b: a + b, [k.cast("int") for k in kinds]).alias("friction_score"))


def mart_campaigns(contacts: DataFrame) -> DataFrame:
    """Acceptance, retention and value per month, region, campaign, channel and offer.

    The retention rate divides all retained contacts by the accepted ones.
    """
    total, accepted = F.count(F.lit(1)), F.count_if(F.col("accepted"))
    retained = {d: F.count_if(F.col(f"retained_{d}d")) for d in (30, 60, 90)}
    return contacts.groupBy("year_month", "region", "campaign_id", "campaign_name", "channel", "offer_type").agg(
        total.alias("contacts"),
        accepted.alias("accepted_offers"),
        *[n.alias(f"retained_{d}d") for d, n in retained.items()],
        numeric.percentage(accepted, total).alias("acceptance_rate_pct"),
        numeric.percentage(retained[90], accepted).alias("retention_90d_pct"),
        F.sum("campaign_cost").alias("campaign_cost"),
        F.sum("estimated_net_value").alias("estimated_net_value"),
    )


def mart_crispdm_dataset(features: DataFrame) -> DataFrame:
    return features


def order_item(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Line items with the order they belong to and the discount taken off."""
    items = lineitem.select("order_key", "part_key", "line_number", "extended_price", "discount_percentage")
    heads = orders.select("order_key", "customer_key", "order_date")
    return items.join(heads, "order_key").select(
        "part_key",
        "line_number",
        "extended_price",
        "order_key",
        "customer_key",
        "order_date",
        numeric.discounted_amount(F.col("extended_price"), F.col("discount_percentage")).alias(
            "item_discount_amount"
        ),
    )
