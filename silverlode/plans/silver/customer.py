"""Customers: one row per customer of full age with a registration in the past."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.functions import dates, numeric, parsing, text
from silverlode.plans.silver.common import extracted_at, lineage, newest_records

# Spanish and English spellings of each code.
GENDERS = {
    "MALE": ("M", "MALE", "MASCULINO", "HOMBRE"),
    "FEMALE": ("F", "FEMALE", "FEMENINO", "MUJER"),
    "NON_BINARY": ("NON_BINARY", "NO BINARIO", "NB"),
}
MARITAL_STATUSES = {
    "MARRIED": ("MARRIED", "CASADO", "CASADA"),
    "SINGLE": ("SINGLE", "SOLTERO", "SOLTERA"),
    "DIVORCED": ("DIVORCED", "DIVORCIADO", "DIVORCIADA"),
    "WIDOWED": ("WIDOWED", "VIUDO", "VIUDA"),
}
# Lower age of each band.
AGE_BANDS = {18: "18_24", 25: "25_34", 35: "35_44", 45: "45_64", 65: "65_PLUS"}
SENIOR_FROM = 65


def clean_customer(raw: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    today = dates.day(as_of)
    c = F.col
    newest = newest_records(raw, "crm_customers")
    staged = newest.select(
        F.trim("customer_id").alias("customer_id"),
        F.sha2(F.coalesce("msisdn", F.lit("")), 256).alias("msisdn_hash"),
        numeric.whole(c("age")).alias("age"),
        text.map_codes(c("gender"), GENDERS).alias("gender"),
        F.coalesce(text.blank_to_null(text.title_case(F.trim("city"))), F.lit("Unknown")).alias("city"),
        text.category(c("region")).alias("region"),
        text.blank_to_null(text.tidy(c("postal_code"))).alias("postal_code"),
        text.map_codes(c("marital_status"), MARITAL_STATUSES).alias("marital_status"),
        parsing.flag(c("senior_citizen")).alias("senior_citizen_source"),
        text.category(c("customer_segment")).alias("customer_segment"),
        parsing.safe_date(raw, "registration_date").alias("registration_date"),
        parsing.flag(c("dependents")).alias("has_dependents_source"),
        numeric.whole(F.coalesce("number_of_dependents", F.lit(0))).alias("dependents"),
        text.category(c("estimated_income_band")).alias("estimated_income_band"),
        extracted_at(),
    )
    senior = c("age") >= SENIOR_FROM
    count = numeric.not_below_zero(c("dependents"))
    bands = sorted(AGE_BANDS.items(), reverse=True)
    return staged.filter(c("registration_date") <= today).select(
        "customer_id",
        "msisdn_hash",
        "age",
        "gender",
        "city",
        "region",
        "postal_code",
        "marital_status",
        senior.alias("senior_citizen"),
        "senior_citizen_source",
        "customer_segment",
        "registration_date",
        (count > 0).alias("has_dependents"),
        "has_dependents_source",
        count.alias("dependents_count"),
        "estimated_income_band",
        text.first_match(
            [
                (c("dependents").isNull(), "IMPUTED_ZERO"),
                (c("dependents") < 0, "CORRECTED_TO_ZERO"),
                (c("has_dependents_source") != (count > 0), "BOOLEAN_ALIGNED_TO_COUNT"),
            ],
            "VALID",
        ).alias("dependents_dq_status"),
        text.first_match(
            [(c("registration_date").isNull(), "MISSING"), (c("registration_date") > today, "FUTURE_TO_EXCLUDE")],
            "VALID",
        ).alias("registration_date_dq_status"),
        text.first_match([(c("senior_citizen_source") != senior, "FLAG_ALIGNED_TO_AGE")], "VALID").alias(
            "senior_dq_status"
        ),
        text.first_match([(c("age") >= low, band) for low, band in bands], "INVALID").alias("age_band"),
        dates.months_between(c("registration_date"), today).alias("customer_tenure_months"),
        *lineage(),
    )
