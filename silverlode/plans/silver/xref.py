"""Pairs of account and customer across source systems."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.functions import text
from silverlode.operators.latest import EXTRACTED_AT
from silverlode.plans.silver.common import newest_records


def clean_xref(raw: DataFrame) -> DataFrame:
    return newest_records(raw, "xref_customer_id").select(
        F.trim("account_id").alias("account_id"),
        F.trim("customer_id").alias("customer_id"),
        text.tidy(F.col("source_crm")).alias("source_crm"),
        text.tidy(F.col("source_billing")).alias("source_billing"),
        F.col(EXTRACTED_AT).alias("source_extracted_at"),
    )
