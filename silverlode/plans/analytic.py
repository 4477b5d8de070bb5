"""Analytic models over the silver tables.

Joins bring attributes of one customer to many rows. The many side is never
collected per customer, and both sides of such a join are exchanged for it, so
adaptive execution can split a customer that owns much of the table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.functions import dates, numeric, text
from silverlode.operators.latest import latest_per_key
from silverlode.operators.skew import join_apart

# Fixed values.
EARLY_MONTHS = 12
HIGH_PRIORITY_MONTHS, MEDIUM_PRIORITY_MONTHS = 12, 6
LABEL_DAYS = 90


def _contracts_with_churn(customer: DataFrame, subscription: DataFrame, churn: DataFrame) -> DataFrame:
    """One row per contract of a known customer, with the churn of that customer.

    Customers meet their churn first: both are one row per customer. Contracts, of
    which one customer may hold very many, are then in one join only.
    """
    profile = customer.select("customer_id", "region", "customer_segment", "gender", "age")
    events = churn.select(
        "customer_id", "churn_date", "churn_reason", "tenure_months_at_end", F.lit(1).alias("churned")
    )
    return join_apart(subscription, profile.join(events, "customer_id", "left"), "customer_id")


def early_churn(
    customer: DataFrame, subscription: DataFrame, churn: DataFrame, as_of: dt.date | None = None
) -> DataFrame:
    """Contracts in their first twelve months, by churn tenure or else by age of the contract."""
    c = F.col
    tenure = F.coalesce(
        c("tenure_months_at_end"), dates.months_between(c("contract_start_date"), dates.day(as_of))
    )
    early = tenure.between(0, EARLY_MONTHS)
    return (
        _contracts_with_churn(customer, subscription.drop("tenure_months"), churn)
        .filter(early)
        .select(
            "customer_id",
            "region",
            "customer_segment",
            "gender",
            "age",
            "subscription_id",
            "plan_name",
            "plan_tier",
            "contract_type",
            "contract_start_date",
            F.coalesce("churned", F.lit(0)).alias("churned"),
            "churn_date",
            "churn_reason",
            "tenure_months_at_end",
            early.alias("is_first_12_months"),
        )
    )


def contract_opportunity(
    customer: DataFrame, subscription: DataFrame, churn: DataFrame, as_of: dt.date | None = None
) -> DataFrame:
    """Month-to-month contracts and how urgent it is to offer a longer one."""
    c = F.col
    monthly = subscription.filter(c("contract_type") == "MONTH_TO_MONTH").drop("tenure_months")
    tenure = dates.months_between(c("contract_start_date"), dates.day(as_of))
    return _contracts_with_churn(customer, monthly, churn).select(
        "customer_id",
        "region",
        "customer_segment",
        "subscription_id",
        "plan_name",
        "plan_tier",
        "contract_type",
        "base_monthly_price",
        "contract_start_date",
        tenure.alias("tenure_months"),
        F.coalesce("churned", F.lit(0)).alias("churned"),
        text.first_match(
            [
                (c("churned") == 1, "NO_ACTION_CHURNED"),
                (tenure >= HIGH_PRIORITY_MONTHS, "HIGH"),
                (tenure >= MEDIUM_PRIORITY_MONTHS, "MEDIUM"),
            ],
            "LOW",
        ).alias("migration_priority"),
    )


# Name of each monthly measure, its type in the common row, and how it is aggregated.
MEASURES: dict[str, tuple[str, object]] = {
    "billed_amount": ("decimal(18,2)", F.sum),
    "billing_amount_change": ("decimal(18,2)", F.sum),
    "failed_payment_attempts": ("bigint", F.sum),
    "outstanding_balance": ("decimal(28,2)", F.sum),
    "total_days_late": ("bigint", F.sum),
    "total_data_gb": ("decimal(19,4)", F.sum),
    "voice_minutes": ("decimal(18,2)", F.sum),
    "dropped_connections": ("bigint", F.sum),
    "outage_seconds": ("decimal(18,2)", F.sum),
    "avg_latency_ms": ("decimal(18,2)", F.avg),
    "avg_packet_loss_pct": ("decimal(18,4)", F.avg),
    "ticket_count": ("bigint", F.sum),
    "avg_resolution_minutes": ("decimal(18,2)", F.avg),
    "avg_satisfaction_score": ("decimal(18,2)", F.avg),
}

# Types of measures that are added in halves, and the type Spark gives to their sum. The widest is the sum of two
# decimals of 18 digits, which is below 2^63 units.
HALVED = {"decimal(18,2)": "decimal(28,2)", "decimal(19,4)": "decimal(29,4)"}


def _measure_rows(df: DataFrame, month: Column, measures: dict[str, Column]) -> DataFrame:
    """Rows in the shape all domains share: customer, month, and every measure."""
    return df.select(
        "customer_id",
        month.alias("month_start"),
        *[
            measures.get(name, F.lit(None)).cast(kind).alias(name)
            for name, (kind, _) in MEASURES.items()
        ],
    )


def payments_of_invoices(payment: DataFrame, billing: DataFrame) -> DataFrame:
    """Monthly payment sums with the customer of the invoice.

    Payments are summed per invoice and month before the join. An invoice that
    many payments name, a placeholder for instance, is thereby down to one row
    per month when its rows have to meet.
    """
    per_invoice = (
        payment.filter(F.col("invoice_id").isNotNull())
        .groupBy("invoice_id", dates.month_start(F.col("payment_date")).alias("month_start"))
        .agg(
            F.sum("failed_attempts").alias("failed_payment_attempts"),
            F.sum("outstanding_balance").alias("outstanding_balance"),
            F.sum("days_late").alias("total_days_late"),
        )
    )
    return per_invoice.join(billing.select("invoice_id", "customer_id"), "invoice_id")


# The name it had before the upkeep took it over.
_payments_of_invoices = payments_of_invoices


def friction_rows(
    billing: DataFrame, paid: DataFrame, usage: DataFrame, network: DataFrame, support: DataFrame
) -> DataFrame:
    """The five domains as rows of one shape; ``paid`` are ``payments_of_invoices``."""
    c = F.col
    # Payments without a date keep their customer-month, but count for nothing in it.
    dated = c("month_start").isNotNull()
    rows = [
        _measure_rows(
            billing,
            dates.month_start(c("issue_date")),
            {"billed_amount": c("total_amount_recalculated"), "billing_amount_change": c("amount_change")},
        ),
        _measure_rows(
            paid,
            c("month_start"),
            {
                name: F.when(dated, c(name))
                for name in ("failed_payment_attempts", "outstanding_balance", "total_days_late")
            },
        ),
        _measure_rows(
            usage,
            dates.month_start(c("usage_date")),
            {
                "total_data_gb": c("data_download_gb") + c("data_upload_gb"),
                "voice_minutes": c("voice_minutes"),
            },
        ),
        _measure_rows(
            network,
            dates.month_start(c("event_timestamp")),
            {
                "dropped_connections": c("connection_dropped_bool").cast("int"),
                "outage_seconds": c("outage_duration_seconds"),
                "avg_latency_ms": c("latency_ms"),
                "avg_packet_loss_pct": c("packet_loss_pct"),
            },
        ),
        _measure_rows(
            support,
            dates.month_start(c("created_timestamp")),
            {
                "ticket_count": F.lit(1),
                "avg_resolution_minutes": c("resolution_minutes_num"),
                "avg_satisfaction_score": c("satisfaction_score"),
            },
        ),
    ]
    union = rows[0]
    for more in rows[1:]:
        union = union.unionByName(more)
    return union


def friction_measures(
    billing: DataFrame, payment: DataFrame, usage: DataFrame, network: DataFrame, support: DataFrame
) -> DataFrame:
    """All measures per customer and month in one aggregation.

    The five domains are laid out as rows of one shape and grouped once, so the
    customer-months exist without being listed first, and one shuffle of
    pre-aggregated rows replaces a distinct union and five joins.
    """
    rows = friction_rows(billing, payments_of_invoices(payment, billing), usage, network, support)
    return _zeros_for_missing(_monthly_totals(rows))


def _zeros_for_missing(measures: DataFrame) -> DataFrame:
    return measures.withColumns({name: F.coalesce(name, F.lit(0)) for name in MEASURES})


def _monthly_totals(rows: DataFrame) -> DataFrame:
    """Rows of ``friction_rows`` by customer and month; a measure without a row is missing.

    A row touches only the sums of its own domain, and decimals are added as pairs of whole numbers.
    """
    added, sums, results = [], [], []
    for name, (kind, how) in MEASURES.items():
        if kind in HALVED and how is F.sum:
            scale = rows.schema[name].dataType.scale
            pair = [f"{name}_upper", f"{name}_lower"]
            added += [half.alias(n) for n, half in zip(pair, numeric.halves(F.col(name), scale), strict=True)]
            sums += [numeric.sum_given(n).alias(n) for n in pair]
            result = numeric.from_halves(*map(F.col, pair), scale).cast(HALVED[kind])
        else:
            added.append(F.col(name))
            sums.append(numeric.sum_given(name, "avg" if how is F.avg else "sum").alias(name))
            result = F.col(name)
        results.append(result.alias(name))
    key = ["customer_id", "month_start"]
    return rows.select(*key, *added).groupBy(*key).agg(*sums).select(*key, *results)


def friction_monthly(
    billing: DataFrame,
    payment: DataFrame,
    usage: DataFrame,
    network: DataFrame,
    support: DataFrame,
    customer: DataFrame,
) -> DataFrame:
    """Billing, payment, usage, network and support friction of each customer-month, with the customer's region."""
    rows = friction_rows(billing, payments_of_invoices(payment, billing), usage, network, support)
    # Missing values move more cheaply than wide zeros.
    return _zeros_for_missing(with_region(_monthly_totals(rows), customer))


def _of_customers(rows: DataFrame, customer: DataFrame) -> DataFrame:
    """Customer-months with one row per customer: that side is hashed, so wide rows are not sorted or copied for each join."""
    return rows.join(customer.hint("shuffle_hash"), "customer_id", "left")


def with_region(measures: DataFrame, customer: DataFrame) -> DataFrame:
    return _of_customers(measures, customer.select("customer_id", "region")).select(
        "customer_id",
        dates.month_key(F.col("month_start")).alias("year_month"),
        "month_start",
        "region",
        *MEASURES,
    )


def campaign_effectiveness(marketing: DataFrame, customer: DataFrame) -> DataFrame:
    """Campaign contacts with the customer's region and segment, and the net value."""
    c = F.col
    known = customer.select("customer_id", "region", "customer_segment")
    net = F.when(c("accepted_bool"), c("estimated_customer_value_num") - c("campaign_cost_num")).otherwise(
        -c("campaign_cost_num")
    )
    return marketing.join(known, "customer_id", "left").select(
        "interaction_id",
        "campaign_id",
        "campaign_name",
        "customer_id",
        "region",
        "customer_segment",
        c("contact_date_parsed").alias("contact_date"),
        dates.month_key(c("contact_date_parsed")).alias("year_month"),
        c("channel_norm").alias("channel"),
        c("offer_type_norm").alias("offer_type"),
        c("discount_pct_num").alias("discount_pct"),
        c("free_months_num").alias("free_months"),
        c("campaign_cost_num").alias("campaign_cost"),
        c("estimated_customer_value_num").alias("estimated_customer_value"),
        c("accepted_bool").alias("accepted"),
        "retained_30d",
        "retained_60d",
        "retained_90d",
        "upgrade_offered",
        "equipment_upgrade",
        "retention_reason",
        net.alias("estimated_net_value"),
    )


def churn_features(
    friction: DataFrame,
    customer: DataFrame,
    subscription: DataFrame,
    macro: DataFrame,
    churn: DataFrame,
) -> DataFrame:
    """Month-end features with a churn label for the next 90 days.

    Months that end on or after the churn are left out, so no feature can have
    seen the outcome. Customers, contracts and churn events are one row per
    customer each; they meet the customer-months on one partitioning.
    """
    c = F.col
    profile = customer.select(
        "customer_id", "age", "gender", "customer_segment", c("senior_citizen").alias("is_senior_citizen")
    )
    contract = latest_per_key(
        subscription.select(
            "customer_id", "subscription_id", "contract_start_date", "plan_tier", "contract_type", "base_monthly_price"
        ),
        ["customer_id"],
        [c("contract_start_date").desc_nulls_first(), c("subscription_id").desc_nulls_first()],
        total=True,
    ).drop("subscription_id", "contract_start_date")
    economy = macro.select(
        "year_month",
        "ipc_index",
        c("desempleo_pct").alias("unemployment_pct"),
        c("inflacion_mensual").alias("monthly_inflation_pct"),
        c("tipo_cambio_bob_usd").alias("bob_usd_exchange_rate"),
        (c("shock_tarifa") == 1).alias("tariff_shock"),
    )
    observed = F.last_day("month_start")
    # These are narrow and one row per customer. Together first, they cost the wide customer-months one join instead of three.
    known = profile.join(contract, "customer_id", "full").join(churn.select("customer_id", "churn_date"), "customer_id", "full")
    joined = _of_customers(friction, known)
    # One row per past month with a four-digit year: at most 12 times as
    # many rows as the year has, whatever the size of the other tables.
    joined = joined.join(F.broadcast(economy), "year_month", "left")
    due = (c("churn_date") > observed) & (c("churn_date") <= F.date_add(observed, LABEL_DAYS))
    return joined.filter(c("churn_date").isNull() | (c("churn_date") > observed)).select(
        *[friction[n] for n in friction.columns],
        observed.alias("observation_date"),
        "age",
        "gender",
        "customer_segment",
        "is_senior_citizen",
        "plan_tier",
        "contract_type",
        "base_monthly_price",
        "ipc_index",
        "unemployment_pct",
        "monthly_inflation_pct",
        "bob_usd_exchange_rate",
        F.coalesce("tariff_shock", F.lit(False)).alias("tariff_shock"),
        F.coalesce(due, F.lit(False)).cast("int").alias("label_churn_next_90d"),
    )
