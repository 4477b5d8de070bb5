"""Analytic and gold rules on hand-made silver rows, and plans under skew."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from silverlode.plans import analytic, facts, marts
from silverlode.plans.silver.customer import clean_customer
from silverlode.plans.silver.marketing import clean_marketing
from silverlode.session import SETTINGS
from silverlode.sources.raw import raw_schema
from tests.conftest import AS_OF

D = dt.date


def silver(spark, columns, *rows):
    return spark.createDataFrame(list(rows), columns)


def billing(spark, *rows):
    return silver(
        spark,
        "invoice_id string, customer_id string, issue_date date, total_amount_recalculated decimal(18,2), amount_change decimal(18,2)",
        *rows,
    )


def payment(spark, *rows):
    return silver(
        spark,
        "invoice_id string, payment_date date, failed_attempts bigint, outstanding_balance decimal(18,2), days_late bigint",
        *rows,
    )


def empty_domains(spark):
    usage = silver(spark, "customer_id string, usage_date date, data_download_gb decimal(18,4), data_upload_gb decimal(18,4), voice_minutes decimal(18,2)")
    network = silver(
        spark,
        "customer_id string, event_timestamp timestamp_ntz, connection_dropped_bool boolean, outage_duration_seconds decimal(18,2),"
        " latency_ms decimal(18,2), packet_loss_pct decimal(18,4)",
    )
    support = silver(
        spark,
        "customer_id string, created_timestamp timestamp_ntz, resolution_minutes_num decimal(18,2), satisfaction_score decimal(18,2)",
        ("C2", dt.datetime(2024, 1, 3), Decimal(10), None),
        ("C2", dt.datetime(2024, 1, 9), Decimal(5), Decimal(4)),
    )
    return usage, network, support


CUSTOMER = "customer_id string, region string, customer_segment string, gender string, age bigint, senior_citizen boolean"


def test_friction_spine(spark):
    bills = billing(spark, ("I1", "C1", D(2024, 1, 5), Decimal("10.00"), Decimal("2.00")))
    paid = payment(
        spark,
        ("I1", None, 3, Decimal("7.00"), 1),
        ("I1", D(2030, 1, 9), 2, Decimal("1.00"), 4),
        ("I1", D(2030, 1, 19), 1, Decimal("1.50"), 0),
        ("unknown", D(2024, 1, 5), 9, Decimal("9.00"), 9),
        (None, D(2024, 1, 5), 9, Decimal("9.00"), 9),
    )
    known = silver(spark, CUSTOMER, ("C1", "LA PAZ", "X", "MALE", 40, False))
    got = {
        (r.customer_id, r.month_start): r
        for r in analytic.friction_monthly(bills, paid, *empty_domains(spark), known).collect()
    }
    assert set(got) == {("C1", D(2024, 1, 1)), ("C1", None), ("C1", D(2030, 1, 1)), ("C2", D(2024, 1, 1))}
    assert got["C1", D(2024, 1, 1)].billed_amount == 10 and got["C1", D(2024, 1, 1)].region == "LA PAZ"
    # A payment without a date makes a row in which nothing counts.
    undated = got["C1", None]
    assert (undated.failed_payment_attempts, undated.outstanding_balance, undated.year_month) == (0, 0, None)
    future = got["C1", D(2030, 1, 1)]
    assert (future.failed_payment_attempts, future.outstanding_balance, future.total_days_late) == (3, Decimal("2.50"), 4)
    tickets = got["C2", D(2024, 1, 1)]
    assert (tickets.ticket_count, tickets.avg_resolution_minutes, tickets.avg_satisfaction_score) == (2, Decimal("7.5"), 4)
    assert tickets.region is None
    scores = {r.customer_id: r.friction_score for r in marts.mart_friction(
        analytic.friction_monthly(bills, paid, *empty_domains(spark), known).filter("month_start = '2024-01-01'")).collect()}
    assert scores == {"C1": 1, "C2": 1}


@pytest.mark.parametrize(
    "churned_on, label",
    [(D(2024, 1, 31), "gone"), (D(2024, 2, 1), 1), (D(2024, 4, 30), 1), (D(2024, 5, 1), 0), (None, 0)],
)
def test_label_window_and_leakage(spark, churned_on, label):
    bills = billing(spark, ("I1", "C1", D(2024, 1, 5), Decimal("10.00"), Decimal("2.00")))
    usage, network, support = empty_domains(spark)
    known = silver(spark, CUSTOMER, ("C1", "LA PAZ", "X", "MALE", 40, False))
    subscriptions = silver(
        spark,
        "customer_id string, subscription_id string, contract_start_date date, plan_tier string, contract_type string, base_monthly_price decimal(18,2)",
        ("C1", "S1", D(2023, 1, 1), "OLD", "X", Decimal(1)),
        ("C1", "S2", D(2023, 5, 1), "A", "X", Decimal(1)),
        ("C1", "S3", D(2023, 5, 1), "B", "X", Decimal(1)),
    )
    macro = silver(
        spark,
        "year_month string, ipc_index double, desempleo_pct double, inflacion_mensual double, tipo_cambio_bob_usd double, shock_tarifa int",
        ("2024-01", 1.0, 2.0, 3.0, 4.0, 1),
    )
    churn = silver(spark, "customer_id string, churn_date date", *([("C1", churned_on)] if churned_on else []))
    friction = analytic.friction_monthly(bills, payment(spark), usage, network, support.filter("false"), known)
    found = analytic.churn_features(friction, known, subscriptions, macro, churn).collect()
    if label == "gone":
        assert found == []
    else:
        assert [(r.label_churn_next_90d, r.plan_tier, r.tariff_shock) for r in found] == [(label, "B", True)]


def contracts(spark, *rows):
    return silver(
        spark,
        "customer_id string, subscription_id string, plan_name string, plan_tier string, contract_type string,"
        " base_monthly_price decimal(18,2), contract_start_date date, contract_end_date date, status string",
        *[(c, s, "P", "T", t, Decimal(1), a, b, "ACTIVE") for c, s, t, a, b in rows],
    )


def test_snapshot(spark):
    df = contracts(
        spark,
        ("C1", "S1", "X", D(2023, 1, 31), D(2023, 3, 1)),
        ("C1", "S2", "Y", D(2023, 3, 1), D(2023, 3, 31)),
        ("C2", "S3", "X", D(2014, 11, 5), D(2015, 1, 20)),
        ("C3", "S4", "X", D(2023, 12, 1), None),
    )
    got = {(r.month_start.isoformat(), r.contract_type, r.tenure_months_at_month_end, r.active_at_month_end_count) for r in facts.fact_customer_month_snapshot(df, AS_OF).collect()}
    assert got == {
        ("2023-01-01", "X", 0, 1),
        ("2023-02-01", "X", 1, 1),
        ("2023-03-01", "Y", 0, 0),
        ("2015-01-01", "X", 2, 0),
        ("2023-12-01", "X", 0, 1),
        ("2024-01-01", "X", 1, 1),
        ("2024-02-01", "X", 2, 1),
    }


def test_early_churn_counts_contracts_over_customers(spark):
    known = silver(spark, CUSTOMER, ("C1", "R", "S", "MALE", 40, False), ("C2", "R", "S", "MALE", 40, False))
    subs = contracts(
        spark,
        ("C1", "S1", "MONTH_TO_MONTH", D(2020, 1, 1), None),
        ("C1", "S2", "ONE_YEAR", D(2023, 6, 1), None),
        ("C2", "S3", "MONTH_TO_MONTH", D(2023, 2, 1), None),
        ("C2", "S4", "MONTH_TO_MONTH", D(2023, 1, 31), None),
        ("C9", "S5", "MONTH_TO_MONTH", D(2024, 1, 1), None),
    )
    gone = silver(spark, "customer_id string, churn_date date, churn_reason string, tenure_months_at_end bigint", ("C1", D(2024, 1, 1), "PRICE", 12))
    early = analytic.early_churn(known, subs, gone, AS_OF)
    # The churn tenure of C1 covers both contracts; S4 is 13 months old.
    assert sorted(r.subscription_id for r in early.collect()) == ["S1", "S2", "S3"]
    mart = marts.mart_churn_early(early).first()
    assert (mart.customers_first_12_months, mart.churned_customers, mart.churn_rate_pct) == (2, 2, 100)
    offers = {r.subscription_id: r.recommended_action for r in marts.mart_contract_opportunity(
        analytic.contract_opportunity(known, subs.withColumn("base_monthly_price", F.lit(Decimal(1))), gone, AS_OF)).collect()}
    assert offers == {"S1": "EXCLUDE", "S3": "OFFER_TWO_YEAR", "S4": "OFFER_TWO_YEAR"}


@pytest.fixture
def small_skew(spark):
    """Adaptive settings under which a few thousand rows are a skewed partition."""
    wanted = {
        **SETTINGS,
        # As in any session: the library does not ask for more.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        # A hot partition is split between the tasks that wrote it; at this size they would be merged into one.
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_ids(spark, n):
    """A third of the rows belong to one customer."""
    return spark.range(0, n, 1, 8).withColumn(
        "customer_id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("C"), F.col("id") % 997))
    )


def run_and_explain(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def known_customers(spark):
    ids = spark.range(0, 997, 1, 8).select(F.concat(F.lit("C"), "id").alias("customer_id"))
    return ids.union(spark.createDataFrame([("hot",)], "customer_id string")).select(
        "customer_id",
        F.lit("R").alias("region"),
        F.lit("S").alias("customer_segment"),
        F.lit("MALE").alias("gender"),
        F.lit(40).alias("age"),
    )


def test_hot_customer_of_a_fact_is_split(spark, small_skew):
    marketing = hot_ids(spark, 30000).select(
        F.concat(F.lit("M"), "id").alias("interaction_id"),
        "customer_id",
        *[F.lit("x").alias(n) for n in ("campaign_id", "campaign_name", "channel_norm", "offer_type_norm", "retention_reason")],
        F.lit(D(2024, 1, 1)).alias("contact_date_parsed"),
        *[F.lit(Decimal("1.00")).alias(n) for n in ("discount_pct_num", "campaign_cost_num", "estimated_customer_value_num")],
        F.lit(1).alias("free_months_num"),
        *[F.lit(True).alias(n) for n in ("accepted_bool", "retained_30d", "retained_60d", "retained_90d", "upgrade_offered", "equipment_upgrade")],
    )
    plan = run_and_explain(analytic.campaign_effectiveness(marketing, known_customers(spark)))
    assert "skew=true" in plan


def filled(df, source):
    """Raw rows of a source; columns the table lacks are missing."""
    wanted = raw_schema(source)
    present = [F.col(f.name) if f.name in df.columns else F.lit(None) for f in wanted]
    return df.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(present, wanted)])


def test_hot_customer_is_split_behind_uncached_silver(spark, small_skew):
    """Silver of both sides is partitioned by its own key, so the join shuffles both."""
    contacts = hot_ids(spark, 30000).select(
        F.concat(F.lit("M"), "id").alias("interaction_id"), "customer_id", F.lit(D(2024, 1, 1)).alias("contact_date")
    )
    customers = known_customers(spark).withColumn("registration_date", F.lit(D(2020, 1, 1)))
    marketing = clean_marketing(filled(contacts, "marketing_retention"), AS_OF)
    df = facts.fact_marketing_interaction(marketing, clean_customer(filled(customers, "crm_customers"), AS_OF))
    plan = run_and_explain(df)
    assert "skew=true" in plan
    assert df.count() == 30000


def test_hot_customer_of_contracts_is_split(spark, small_skew):
    subs = hot_ids(spark, 30000).select(
        "customer_id",
        F.concat(F.lit("S"), "id").alias("subscription_id"),
        F.lit("P").alias("plan_name"),
        F.lit("T").alias("plan_tier"),
        F.lit("MONTH_TO_MONTH").alias("contract_type"),
        F.lit(D(2023, 6, 1)).alias("contract_start_date"),
    )
    churn = silver(spark, "customer_id string, churn_date date, churn_reason string, tenure_months_at_end bigint", ("C1", D(2024, 1, 1), "PRICE", 12))
    df = analytic.early_churn(known_customers(spark), subs, churn, AS_OF)
    plan = run_and_explain(df)
    assert "skew=true" in plan
    assert df.count() == 30000


def test_hot_contract_and_customer_of_invoices_are_split(spark, small_skew):
    """Both joins of the billing fact, one after the other."""
    labels = "account_id billing_period invoice_status currency".split()
    amounts = "base_charge service_charge equipment_charge extra_usage_charge tax discount total_amount_source total_amount_recalculated".split()
    changes = "amount_variance previous_month_amount amount_change amount_change_pct".split()
    invoices = hot_ids(spark, 30000).select(
        "customer_id",
        F.concat(F.lit("S"), "customer_id").alias("subscription_id"),
        # Text that does not compress, so that rows tell the sizes of partitions.
        F.md5(F.col("id").cast("string")).alias("invoice_id"),
        *[F.lit("x").alias(n) for n in labels],
        *[F.lit(D(2024, 1, 1)).alias(n) for n in ("issue_date", "due_date")],
        *[F.lit(Decimal("1.00")).alias(n) for n in amounts + changes],
        *[F.lit(True).alias(n) for n in ("dq_valid_dates", "dq_nonnegative_total", "dq_total_match")],
        *[F.lit(None).cast("string").alias(n) for n in facts.ORIGIN],
    )
    people = known_customers(spark)
    plans = people.select(F.concat(F.lit("S"), "customer_id").alias("subscription_id"), F.lit("P").alias("plan_name"), F.lit("T").alias("plan_tier"))
    df = facts.fact_billing(invoices, plans, people)
    assert run_and_explain(df).count("skew=true") == 2
    assert df.count() == 30000


def test_contracts_meet_customers_and_churn_as_in_plain_python(spark):
    rng = random.Random(7)
    ids = [None, *"ABCDEF"]
    known = [i for i in ids[1:] if i != "F"]
    left = [(rng.choice(ids), n) for n in range(60)]
    contracts = spark.createDataFrame(left, "customer_id string, subscription_id long")
    people = spark.createDataFrame([(i, "R", "S", "MALE", 40) for i in known], "customer_id string, region string, customer_segment string, gender string, age int")
    gone = spark.createDataFrame([(i, D(2024, 1, 1), "PRICE", 3) for i in "ACF"], "customer_id string, churn_date date, churn_reason string, tenure_months_at_end int")
    got = analytic._contracts_with_churn(people, contracts, gone).select("subscription_id", "customer_id", "churned").collect()
    want = [(n, i, 1 if i in ("A", "C") else None) for i, n in left if i in known]
    assert sorted(map(tuple, got)) == sorted(want)


def test_invoice_named_by_a_third_of_payments_is_summed_before_the_join(spark, small_skew):
    paid = spark.range(0, 30000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "I0").otherwise(F.concat(F.lit("I"), "id")).alias("invoice_id"),
        F.lit(D(2024, 1, 5)).alias("payment_date"),
        F.lit(1).cast("bigint").alias("failed_attempts"),
        F.lit(Decimal("1.00")).cast("decimal(18,2)").alias("outstanding_balance"),
        F.lit(2).cast("bigint").alias("days_late"),
    )
    bills = spark.range(0, 30000, 1, 8).select(
        F.concat(F.lit("I"), "id").alias("invoice_id"),
        F.concat(F.lit("C"), "id").alias("customer_id"),
        F.lit(D(2024, 1, 5)).alias("issue_date"),
        F.lit(Decimal("1.00")).cast("decimal(18,2)").alias("total_amount_recalculated"),
        F.lit(Decimal("0.00")).cast("decimal(18,2)").alias("amount_change"),
    )
    usage, network, support = empty_domains(spark)
    got = analytic.friction_measures(bills, paid, usage, network, support.filter("false"))
    assert got.filter("customer_id = 'C0'").first().failed_payment_attempts == 10000
    assert got.agg(F.sum("failed_payment_attempts")).first()[0] == 30000
    joined = analytic._payments_of_invoices(paid, bills)
    assert joined.filter("invoice_id = 'I0'").count() == 1


def test_months_of_contracts_do_not_move(spark):
    contract = [F.lit(n).alias(n) for n in ("plan_name", "plan_tier", "contract_type", "status")]
    contracts = spark.range(0, 3000, 1, 4).select(
        F.concat(F.lit("C"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40)).alias("customer_id"),
        F.concat(F.lit("S"), "id").alias("subscription_id"),
        *contract,
        F.col("id").cast("decimal(18,2)").alias("base_monthly_price"),
        F.date_sub(F.lit(AS_OF), (F.col("id") * 7 % 900).cast("int")).alias("contract_start_date"),
        F.when(F.col("id") % 2 == 0, F.date_sub(F.lit(AS_OF), (F.col("id") * 11 % 700).cast("int"))).alias("contract_end_date"),
    )
    got = facts.fact_customer_month_snapshot(contracts, AS_OF)
    above = got._jdf.queryExecution().sparkPlan().toString()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in above and "Exchange" not in plan[: plan.index("Generate")]
    # The newest contract of each month, found in plain code.
    want = {}
    for r in contracts.collect():
        end = r.contract_end_date or AS_OF
        at = r.contract_start_date.replace(day=1)
        while at <= end:
            key = (r.customer_id, at)
            want[key] = max(want.get(key, (r.contract_start_date, "")), (r.contract_start_date, r.subscription_id, r.base_monthly_price))
            at = (at + dt.timedelta(days=32)).replace(day=1)
    found = {(r.month_start, r.base_monthly_price) for r in got.collect()}
    assert got.count() == len(want) and found == {(month, best[2]) for (_, month), best in want.items()}


def test_customer_months_meet_their_customers_in_two_joins_and_are_not_sorted(spark):
    billed = billing(spark, ("I1", "C1", D(2024, 1, 5), Decimal("9999999999999999.99"), Decimal("-0.01")),
                     ("I2", "C1", D(2024, 1, 9), Decimal("9999999999999999.99"), Decimal("-9999999999999999.99")),
                     ("I3", "C2", D(2024, 1, 9), None, None))
    usage, network, support = empty_domains(spark)
    customer = silver(
        spark, "customer_id string, region string, age int, gender string, customer_segment string, senior_citizen boolean",
        ("C1", "R1", 30, "MALE", "S", False), ("C3", "R3", 31, "MALE", "S", False))
    friction = analytic.friction_monthly(
        billed, payment(spark), usage, network, support.filter("false"), customer
    ).filter("month_start IS NOT NULL")
    subscriptions = silver(
        spark, "customer_id string, subscription_id string, contract_start_date date, plan_tier string, contract_type string, base_monthly_price decimal(18,2)",
        ("C2", "S2", D(2023, 1, 1), "GOLD", "ONE_YEAR", Decimal("5.00")))
    macro = silver(
        spark, "year_month string, ipc_index decimal(18,4), desempleo_pct decimal(18,4), inflacion_mensual decimal(18,4), "
        "tipo_cambio_bob_usd decimal(18,6), shock_tarifa int")
    churn = silver(spark, "customer_id string, churn_date date", ("C2", D(2024, 2, 9)), ("C4", D(2024, 2, 9)))
    features = analytic.churn_features(friction, customer, subscriptions, macro, churn)
    rows = {r["customer_id"]: r for r in features.collect()}
    assert set(rows) == {"C1", "C2"}
    assert rows["C1"]["billed_amount"] == Decimal("19999999999999999.98")
    assert rows["C1"]["billing_amount_change"] == Decimal("-10000000000000000.00")
    assert (rows["C1"]["region"], rows["C1"]["plan_tier"], rows["C1"]["label_churn_next_90d"]) == ("R1", None, 0)
    assert (rows["C2"]["age"], rows["C2"]["plan_tier"], rows["C2"]["label_churn_next_90d"]) == (None, "GOLD", 1)
    assert rows["C2"]["billed_amount"] == rows["C2"]["avg_latency_ms"] == 0
    plan = features._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ShuffledHashJoin [customer_id") == 2, plan
