"""Monthly retention targets per region, read out of free text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.functions import numeric, parsing, text
from silverlode.plans.silver.common import extracted_at, lineage, newest_records

# Fixed values.
RATE_CAP = 100


def _status(value: Column, *more: tuple[Column, str]) -> Column:
    return text.first_match(
        [(value.isNull(), "IMPUTED_ZERO"), (value < 0, "NEGATIVE_CORRECTED_TO_ZERO"), *more], "VALID"
    )


def clean_retention_target(raw: DataFrame) -> DataFrame:
    """Targets for coming months stay."""
    c = F.col
    newest = newest_records(raw, "metas_retencion_region_mes")
    staged = newest.select(
        F.trim("target_id").alias("target_id"),
        text.category(c("region")).alias("region"),
        F.trim("year_month").alias("year_month"),
        parsing.month_key_to_date(F.trim("year_month")).alias("month_start"),
        parsing.number_in_text(c("arpu_target_bob"), 18, 2).alias("arpu"),
        parsing.number_in_text(c("active_base_target"), 38, 0).cast("bigint").alias("base"),
        parsing.number_in_text(c("retention_budget_bob"), 18, 2).alias("budget"),
        parsing.number_in_text(c("churn_rate_target_pct"), 18, 4).alias("rate"),
        parsing.number_in_text(c("retained_customers_target"), 38, 0).cast("bigint").alias("retained"),
        text.category(c("responsable_comercial"), "UNASSIGNED").alias("responsable_comercial"),
        parsing.safe_timestamp(raw, "ultima_actualizacion").alias("ultima_actualizacion_ts"),
        text.blank_to_null(F.trim("comentario")).alias("comentario"),
        extracted_at(),
    )
    base = numeric.not_below_zero(c("base"))
    retained = numeric.not_below_zero(c("retained"))
    within_base = F.least(retained, base)
    return staged.filter(c("month_start").isNotNull()).select(
        "target_id",
        "region",
        "year_month",
        "month_start",
        numeric.positive_amount(c("arpu")).alias("arpu_target_bob_num"),
        base.alias("active_base_target_num"),
        numeric.positive_amount(c("budget")).alias("retention_budget_bob_num"),
        numeric.amount(numeric.clamp(c("rate"), RATE_CAP), 4).alias("churn_rate_target_pct_num"),
        within_base.alias("retained_customers_target_num"),
        "responsable_comercial",
        "ultima_actualizacion_ts",
        "comentario",
        numeric.ratio(
            within_base.cast("decimal(20,0)") * F.lit(100).cast("decimal(3,0)"), base.cast("decimal(20,0)")
        ).alias("retention_rate_target_pct_num"),
        (
            parsing.is_month_key(c("year_month"))
            & (c("month_start") == parsing.month_key_to_date(c("year_month")))
        ).alias("dq_valid_year_month"),
        _status(c("arpu")).alias("arpu_target_dq_status"),
        _status(c("rate"), (c("rate") > RATE_CAP, "CAPPED_AT_100")).alias("churn_target_dq_status"),
        _status(c("retained"), (retained > base, "CAPPED_TO_ACTIVE_BASE")).alias("retained_target_dq_status"),
        _status(c("budget")).alias("budget_target_dq_status"),
        *lineage(),
    )
