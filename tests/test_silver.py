"""Silver rules that the stand-in tables cannot show."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from silverlode.operators.latest import latest_version
from silverlode.plans.silver.billing import clean_billing
from silverlode.plans.silver.churn import clean_churn
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
from silverlode.sources import derived
from silverlode.sources.raw import COLUMNS, raw_schema
from tests.conftest import AS_OF

NEW = dt.datetime(2024, 1, 31)
OLD = dt.datetime(2024, 1, 30)


def raw(spark, source, *rows, overrides=None):
    """Raw rows with the given values; everything else is missing."""
    schema = raw_schema(source, overrides)
    filled = []
    for row in rows:
        row = {"_airbyte_extracted_at": NEW, "_airbyte_generation_id": 1, **row}
        unknown = set(row) - set(schema.names)
        assert not unknown, unknown
        filled.append(tuple(row.get(n) for n in schema.names))
    return spark.createDataFrame(filled, schema)


def rows(df):
    return [r.asDict() for r in df.collect()]


def one(df):
    found = rows(df)
    assert len(found) == 1, found
    return found[0]


def customer(**more):
    return {"customer_id": "C1", "age": 40, "registration_date": dt.date(2020, 5, 20), **more}


@pytest.mark.parametrize("source", sorted(COLUMNS))
def test_stand_in_tables_have_the_declared_columns(spark, source):
    assert derived.derive(spark, source, "/root/testdata/sf0.001").dtypes == [
        (f.name, f.dataType.simpleString()) for f in raw_schema(source)
    ]


def test_newest_version_wins_and_padding_does_not_matter(spark):
    df = raw(
        spark,
        "crm_customers",
        customer(customer_id=" C1 ", city="old", _airbyte_extracted_at=OLD, _airbyte_generation_id=9),
        customer(city="new"),
        customer(city="newer", _airbyte_generation_id=2),
    )
    assert one(clean_customer(df, AS_OF))["city"] == "Newer"


def test_missing_generation_counts_as_newest(spark):
    df = raw(spark, "crm_customers", customer(city="a", _airbyte_generation_id=5), customer(city="b", _airbyte_generation_id=None))
    assert one(clean_customer(df, AS_OF))["city"] == "B"


def test_ties_do_not_depend_on_the_order_of_rows(spark):
    tied = [customer(city=f"city {i}") for i in range(40)]
    forward = one(clean_customer(raw(spark, "crm_customers", *tied).repartition(7), AS_OF))
    backward = one(clean_customer(raw(spark, "crm_customers", *tied[::-1]).coalesce(1), AS_OF))
    assert forward == backward


def test_older_valid_version_replaces_newer_invalid_one(spark):
    df = raw(spark, "crm_customers", customer(age=999), customer(age=30, _airbyte_extracted_at=OLD))
    assert one(clean_customer(df, AS_OF))["age"] == 30


def test_newest_version_in_the_future_removes_the_record(spark):
    df = raw(
        spark,
        "crm_customers",
        customer(registration_date=dt.date(2030, 1, 1)),
        customer(_airbyte_extracted_at=OLD),
    )
    assert rows(clean_customer(df, AS_OF)) == []


def test_customer_values(spark):
    got = one(
        clean_customer(
            raw(spark, "crm_customers", customer(gender="hombre", number_of_dependents=-2, dependents=1, age=65)), AS_OF
        )
    )
    assert got["gender"] == "MALE" and got["age_band"] == "65_PLUS" and got["senior_citizen"] is True
    assert got["dependents_count"] == 0 and got["dependents_dq_status"] == "CORRECTED_TO_ZERO"
    assert got["senior_dq_status"] == "FLAG_ALIGNED_TO_AGE" and got["has_dependents"] is False
    assert got["customer_tenure_months"] == 45
    # The hash of an empty number stands for a missing one.
    assert got["msisdn_hash"] == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


@pytest.mark.parametrize("age, band", [(18, "18_24"), (24, "18_24"), (25, "25_34"), (35, "35_44"), (45, "45_64"), (64, "45_64"), (120, "65_PLUS")])
def test_age_bands(spark, age, band):
    assert one(clean_customer(raw(spark, "crm_customers", customer(age=age)), AS_OF))["age_band"] == band


def test_customer_dates_as_text(spark):
    df = raw(
        spark,
        "crm_customers",
        customer(registration_date="2020-05-20 10:00:00"),
        customer(customer_id="C2", registration_date="2020-02-30"),
        overrides={"registration_date": "string"},
    )
    assert one(clean_customer(df, AS_OF))["registration_date"] == dt.date(2020, 5, 20)


def contract(**more):
    return {"subscription_id": "S1", "customer_id": "C1", "contract_start_date": dt.date(2023, 1, 10), **more}


@pytest.mark.parametrize(
    "more, status",
    [
        ({}, "VALID"),
        ({"contract_end_date": dt.date(2022, 1, 1)}, "INVALID_END_DATE_TO_NULL"),
        ({"plan_change_date": dt.date(2022, 1, 1)}, "INVALID_PLAN_CHANGE_TO_NULL"),
        ({"plan_change_date": dt.date(2023, 2, 1)}, "MISSING_PREVIOUS_PLAN"),
        ({"plan_change_date": dt.date(2023, 2, 1), "previous_plan": "x"}, "VALID"),
        ({"base_monthly_price": Decimal("-5")}, "VALID"),
    ],
)
def test_subscription_status(spark, more, status):
    got = one(clean_subscription(raw(spark, "subscriptions_contracts", contract(**more)), AS_OF))
    assert got["subscription_dq_status"] == status and got["base_monthly_price"] == 0


def test_subscription_activity(spark):
    df = raw(
        spark,
        "subscriptions_contracts",
        contract(status="activo"),
        contract(subscription_id="S2", status="activo", contract_end_date=dt.date(2024, 1, 31)),
        contract(subscription_id="S3", status="baja", contract_end_date=dt.date(2024, 6, 1)),
        contract(subscription_id="S4", contract_start_date=dt.date(2024, 2, 2)),
    )
    got = {r["subscription_id"]: r for r in rows(clean_subscription(df, AS_OF))}
    assert {k: (r["is_active_subscription"], r["churn_candidate_flag"], r["tenure_months"]) for k, r in got.items()} == {
        "S1": (True, False, 13),
        "S2": (False, True, 12),
        "S3": (False, True, 17),
    }


def invoice(**more):
    return {"invoice_id": "I1", "customer_id": "C1", "issue_date": dt.date(2024, 1, 5), "total_amount": Decimal("10"), **more}


@pytest.mark.parametrize(
    "more, status, variance",
    [
        ({"base_charge": Decimal("10")}, "VALID", "0.00"),
        ({"base_charge": Decimal("10.05")}, "VALID", "-0.05"),
        ({"base_charge": Decimal("10.06")}, "TOTAL_MISMATCH_REVIEW", "-0.06"),
        ({"base_charge": Decimal("12"), "discount": Decimal("2"), "tax": Decimal("-3")}, "VALID", "0.00"),
        ({"total_amount": None}, "TOTAL_IMPUTED_ZERO", "0.00"),
        ({"base_charge": Decimal("10"), "due_date": dt.date(2024, 1, 4)}, "INVALID_DUE_DATE_TO_NULL", "0.00"),
    ],
)
def test_billing_status(spark, more, status, variance):
    got = one(clean_billing(raw(spark, "billing_invoices", invoice(**more)), AS_OF))
    assert (got["billing_dq_status"], got["amount_variance"]) == (status, Decimal(variance))
    assert got["currency"] == "BOB" and got["billing_period"] == "2024-01" and got["amount_change"] == 0


def test_negative_newest_total_brings_back_the_older_invoice(spark):
    df = raw(
        spark, "billing_invoices", invoice(total_amount=Decimal("-20")), invoice(account_id="old", _airbyte_extracted_at=OLD)
    )
    assert one(clean_billing(df, AS_OF))["account_id"] == "old"


def pay(**more):
    return {"payment_id": "P1", "customer_id": "C1", "amount_due": Decimal("100"), "amount_paid": Decimal("100"), **more}


@pytest.mark.parametrize(
    "more, status",
    [
        ({}, "VALID"),
        ({"payment_date": dt.date(2024, 2, 2)}, "FUTURE_PAYMENT_DATE_REVIEW"),
        ({"amount_paid": Decimal("105")}, "VALID"),
        ({"amount_paid": Decimal("105.01")}, "OVERPAYMENT_REVIEW"),
        ({"amount_paid": Decimal("90"), "outstanding_balance": Decimal("9.95")}, "VALID"),
        ({"amount_paid": Decimal("90"), "outstanding_balance": Decimal("9.94")}, "BALANCE_RECALCULATED"),
        ({"amount_due": None, "amount_paid": None}, "VALID"),
    ],
)
def test_payment_status(spark, more, status):
    got = one(clean_payment(raw(spark, "payments", pay(**more)), AS_OF))
    assert got["payment_dq_status"] == status and got["days_late_dq_status"] == "VALID"
    assert got["collection_action"] == "NONE"


def usage(**more):
    return {"usage_id": "U1", "customer_id": "C1", "usage_date": dt.date(2024, 1, 5), **more}


@pytest.mark.parametrize(
    "more, status",
    [
        ({}, "NO_RECORDED_USAGE"),
        ({"sms_count": 1}, "VALID"),
        ({"streaming_hours": Decimal("48")}, "OUTLIER_CAPPED"),
        ({"avg_session_minutes": Decimal("1440.01")}, "OUTLIER_CAPPED"),
        ({"data_download_gb": Decimal("10"), "peak_usage_gb": Decimal("9")}, "VALID"),
        ({"data_download_gb": Decimal("10"), "peak_usage_gb": Decimal("8.9999")}, "USAGE_COMPONENT_MISMATCH"),
        ({"sms_count": -3, "voice_minutes": Decimal("-1")}, "NO_RECORDED_USAGE"),
    ],
)
def test_usage_status(spark, more, status):
    got = one(clean_usage(raw(spark, "service_usage", usage(**more)), AS_OF))
    assert got["usage_dq_status"] == status and got["streaming_hours"] <= 24 and got["sms_count"] >= 0


def event(**more):
    return {
        "event_id": "E1",
        "customer_id": "C1",
        "timestamp": "2024-01-05 10:00:00",
        "signal_strength_dbm": Decimal("-80"),
        **more,
    }


@pytest.mark.parametrize(
    "more, status, band",
    [
        ({}, "VALID", "NORMAL"),
        ({"latency_ms": Decimal("-15.5")}, "NEGATIVE_METRIC_CORRECTED", "NORMAL"),
        ({"packet_loss_pct": Decimal("101")}, "PACKET_LOSS_CAPPED", "DEGRADED"),
        ({"signal_strength_dbm": None}, "INVALID_SIGNAL_TO_NULL", "WEAK_SIGNAL"),
        ({"signal_strength_dbm": Decimal("-111")}, "VALID", "WEAK_SIGNAL"),
        ({"latency_ms": Decimal("20000")}, "EXTREME_OUTLIER_CAPPED", "DEGRADED"),
        ({"outage_duration_seconds": Decimal("1")}, "VALID", "OUTAGE_OR_DROP"),
        ({"connection_dropped": "on"}, "VALID", "OUTAGE_OR_DROP"),
    ],
)
def test_network_status(spark, more, status, band):
    got = one(clean_network(raw(spark, "network_quality", event(**more)), AS_OF))
    assert (got["network_dq_status"], got["network_quality_band"]) == (status, band)
    assert 0 <= got["latency_ms"] <= 10000


def test_deleted_newest_version_brings_back_the_live_one(spark):
    df = raw(
        spark,
        "network_quality",
        event(_ab_cdc_deleted_at="2024-01-31"),
        event(device_id="live", _airbyte_extracted_at=OLD),
        event(event_id="E2", _ab_cdc_deleted_at="2024-01-31"),
        event(event_id="E3", timestamp="N/A"),
        event(event_id="E4", timestamp="2024-02-02 00:00:00"),
    )
    assert one(clean_network(df, AS_OF))["device_id"] == "live"


def ticket(**more):
    return {
        "ticket_id": "T1",
        "customer_id": "C1",
        "created_at": "2024-01-05 10:00:00",
        "resolved_at": "2024-01-06 10:00:00",
        "status": "cerrado",
        **more,
    }


@pytest.mark.parametrize(
    "more, expected",
    [
        ({}, {"support_dq_status": "VALID", "sla_status": "WITHIN_SLA", "classification": "GENERAL"}),
        ({"resolved_at": None}, {"support_dq_status": "CLOSED_WITHOUT_VALID_RESOLUTION", "sla_status": "OPEN_OR_UNRESOLVED"}),
        ({"resolved_at": "2024-01-01"}, {"support_dq_status": "INVALID_RESOLUTION_TO_NULL", "resolved_timestamp": None}),
        ({"satisfaction_score": Decimal("6")}, {"support_dq_status": "SATISFACTION_OUTLIER_TO_NULL", "satisfaction_score": None}),
        ({"priority": "urgent", "resolution_minutes": "240.6"}, {"sla_status": "SLA_BREACH", "resolution_minutes_num": 241}),
        ({"priority": "high", "resolution_minutes": "480"}, {"sla_status": "WITHIN_SLA"}),
        ({"priority": "low", "resolution_minutes": "1441"}, {"sla_status": "SLA_BREACH"}),
        ({"resolution_minutes": "-15"}, {"resolution_minutes_num": 0}),
        ({"category": "billing", "reason": "wants to cancel"}, {"classification": "RETENTION_RISK"}),
        ({"reason": "late payment"}, {"classification": "BILLING"}),
        ({"reason": "no signal"}, {"classification": "NETWORK"}),
        ({"category": "tech"}, {"classification": "TECHNICAL"}),
    ],
)
def test_support_rules(spark, more, expected):
    got = one(clean_support(raw(spark, "support_tickets", ticket(**more)), AS_OF))
    assert {k: got[k] for k in expected} == expected


def contact(**more):
    return {"interaction_id": "M1", "customer_id": "C1", "contact_date": dt.date(2024, 1, 5), **more}


@pytest.mark.parametrize(
    "more, status",
    [
        ({}, "VALID"),
        ({"response_date": dt.date(2024, 1, 4)}, "INVALID_RESPONSE_DATE_TO_NULL"),
        ({"response_date": dt.date(2024, 2, 2)}, "INVALID_RESPONSE_DATE_TO_NULL"),
        ({"discount_pct": Decimal("150")}, "DISCOUNT_CAPPED"),
        ({"free_months": 25}, "FREE_MONTHS_CAPPED"),
        ({"retained_90d": True, "retained_30d": True}, "RETENTION_WINDOWS_CORRECTED"),
        ({"retained_30d": True}, "VALID"),
    ],
)
def test_marketing_status(spark, more, status):
    got = one(clean_marketing(raw(spark, "marketing_retention", contact(**more)), AS_OF))
    assert got["marketing_dq_status"] == status and got["response_date_parsed"] is None
    assert got["discount_pct_num"] <= 100 and got["free_months_num"] <= 24
    assert got["retained_90d"] <= got["retained_60d"] <= got["retained_30d"]
    assert got["campaign_name"] == "Unknown" and got["estimated_campaign_roi"] is None


def label(**more):
    return {"customer_id": "C1", "churned": 1, "churn_date": dt.date(2024, 1, 31), **more}


def churn_of(spark, *labels):
    known = clean_customer(raw(spark, "crm_customers", customer()), AS_OF)
    return clean_churn(raw(spark, "churn_labels", *labels), known, AS_OF)


def test_newest_label_decides(spark):
    assert rows(churn_of(spark, label(churned=0), label(_airbyte_extracted_at=OLD))) == []
    assert one(churn_of(spark, label(churned=2), label(_airbyte_extracted_at=OLD)))["customer_id"] == "C1"


@pytest.mark.parametrize(
    "more, expected",
    [
        ({"tenure_months_at_end": 43}, {"churn_dq_status": "VALID", "tenure_months_at_end": 44}),
        ({"tenure_months_at_end": 42}, {"churn_dq_status": "TENURE_RECALCULATED", "tenure_months_at_end": 44}),
        ({"customer_id": "C9", "tenure_months_at_end": 7}, {"tenure_months_at_end": 7, "tenure_months_recalculated": None}),
        ({"churn_reason": "Too expensive!!!"}, {"churn_reason": "PRICE"}),
        ({"churn_reason": " "}, {"churn_reason": "UNKNOWN"}),
        ({"churn_reason": "bad attention"}, {"churn_reason": "CUSTOMER_SERVICE"}),
        ({"churn_reason": "x"}, {"churn_reason": "OTHER"}),
        ({"churn_date": dt.date(2024, 1, 2)}, {"churn_recency_window": "CHURN_0_30_DAYS", "days_since_churn": 30}),
        ({"churn_date": dt.date(2024, 1, 1)}, {"churn_recency_window": "CHURN_31_60_DAYS"}),
        ({"churn_date": dt.date(2023, 11, 2)}, {"churn_recency_window": "CHURN_OVER_90_DAYS"}),
    ],
)
def test_churn_rules(spark, more, expected):
    got = one(churn_of(spark, label(**more)))
    assert {k: got[k] for k in expected} == expected


@pytest.mark.parametrize("day", [None, dt.date(2024, 2, 2), dt.date(2020, 5, 19)])
def test_churn_without_a_possible_date_is_dropped(spark, day):
    assert rows(churn_of(spark, label(churn_date=day))) == []


def test_macro(spark):
    full = {"ipc_index": Decimal("1"), "desempleo_pct": Decimal("5"), "inflacion_mensual": Decimal("0"), "tipo_cambio_bob_usd": Decimal("7")}
    df = raw(
        spark,
        "macro_monthly",
        {"year_month": "2024-01", **full, "shock_tarifa": 1},
        {"year_month": "2023-12", **full, "ipc_index": Decimal("0")},
        {"year_month": "2023-11", **full, "desempleo_pct": None},
        {"year_month": "2024-02", **full},
        {"year_month": "2024-03", **full},
        {"year_month": "2024-13", **full},
    )
    got = {r["year_month"]: r for r in rows(clean_macro(df, AS_OF))}
    assert {k: r["macro_dq_status"] for k, r in got.items()} == {
        "2024-01": "VALID",
        "2023-12": "OUTLIER_TO_NULL",
        "2023-11": "MISSING_INDICATOR_TO_NULL",
        "2024-02": "VALID",
    }
    assert got["2023-12"]["ipc_index"] is None and got["2023-11"]["dq_valid_unemployment"] is None
    assert got["2024-01"]["shock_tarifa"] == 1


def test_targets(spark):
    base = {"year_month": "2030-01", "active_base_target": "1,000", "retained_customers_target": "900"}
    df = raw(
        spark,
        "metas_retencion_region_mes",
        {"target_id": "G1", **base, "arpu_target_bob": "$ 1.200 BOB", "churn_rate_target_pct": "150%"},
        {"target_id": "G2", **base, "retained_customers_target": "2000", "arpu_target_bob": "-3"},
        {"target_id": "G3", **base, "year_month": "2024-1"},
    )
    got = {r["target_id"]: r for r in rows(clean_retention_target(df))}
    assert set(got) == {"G1", "G2"}
    assert got["G1"]["arpu_target_bob_num"] == Decimal("1.20")
    assert got["G1"]["churn_target_dq_status"] == "CAPPED_AT_100" and got["G1"]["churn_rate_target_pct_num"] == 100
    assert got["G1"]["retention_rate_target_pct_num"] == 90
    assert got["G2"]["retained_target_dq_status"] == "CAPPED_TO_ACTIVE_BASE" and got["G2"]["retained_customers_target_num"] == 1000
    assert got["G2"]["arpu_target_dq_status"] == "NEGATIVE_CORRECTED_TO_ZERO"
    assert got["G1"]["budget_target_dq_status"] == "IMPUTED_ZERO" and got["G1"]["responsable_comercial"] == "UNASSIGNED"


def test_xref(spark):
    df = raw(
        spark,
        "xref_customer_id",
        {"account_id": " A1", "customer_id": "C1", "source_crm": "new"},
        {"account_id": "A1 ", "customer_id": "C1", "source_crm": "old", "_airbyte_extracted_at": OLD},
        {"account_id": "A1", "customer_id": "C2", "source_crm": "crm"},
        {"account_id": " ", "customer_id": "C2"},
    )
    got = {(r["account_id"], r["customer_id"]): r["source_crm"] for r in rows(clean_xref(df))}
    assert got == {("A1", "C1"): "NEW", ("A1", "C2"): "CRM"}


def test_one_key_with_most_of_the_rows_is_thinned_before_the_shuffle(spark):
    """Each task passes on one row of the hot key, however many it has."""
    hot = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("C"), "id")).alias("customer_id"),
        F.lit(40).alias("age"),
        F.lit(NEW).alias("_airbyte_extracted_at"),
        F.col("id").alias("_airbyte_generation_id"),
    )
    df = latest_version(hot, "customer_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    newest = {r[0]: r[1] for r in df.select("customer_id", "_airbyte_generation_id").collect()}
    assert newest["hot"] == 19998 and len(newest) == 20000 - 6667 + 1
