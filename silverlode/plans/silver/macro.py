"""Monthly economic indicators within plausible ranges."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverlode.functions import dates, numeric, parsing, text
from silverlode.plans.silver.common import extracted_at, keep_if, lineage, newest_records

# Decimal places of each indicator and the name of its check.
INDICATORS = {
    "ipc_index": (4, "dq_valid_ipc"),
    "desempleo_pct": (4, "dq_valid_unemployment"),
    "inflacion_mensual": (4, "dq_valid_inflation"),
    "tipo_cambio_bob_usd": (6, "dq_valid_exchange_rate"),
}


def _plausible():
    """Open ranges for levels, closed ranges for percentages."""
    c = F.col
    return {
        "ipc_index": (c("ipc_index") > 0) & (c("ipc_index") < 10000),
        "desempleo_pct": c("desempleo_pct").between(0, 100),
        "inflacion_mensual": c("inflacion_mensual").between(-50, 100),
        "tipo_cambio_bob_usd": (c("tipo_cambio_bob_usd") > 0) & (c("tipo_cambio_bob_usd") < 100),
    }


def clean_macro(raw: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    c = F.col
    this_month = dates.month_start(dates.day(as_of))
    newest = newest_records(raw, "macro_monthly")
    staged = newest.select(
        F.trim("year_month").alias("year_month"),
        parsing.month_key_to_date(F.trim("year_month")).alias("month_start"),
        *[
            numeric.amount(c(name), scale).cast("double").alias(name)
            for name, (scale, _) in INDICATORS.items()
        ],
        parsing.flag(c("shock_tarifa")).cast("int").alias("shock_tarifa"),
        extracted_at(),
    )
    plausible = _plausible()
    valid_month = parsing.is_month_key(c("year_month")) & (
        c("month_start") == parsing.month_key_to_date(c("year_month"))
    )
    missing = reduce(lambda a, b: a | b, [c(n).isNull() for n in INDICATORS])
    outlier = reduce(lambda a, b: a | b, [~plausible[n] for n in INDICATORS])
    return staged.filter(c("month_start") <= this_month).select(
        "year_month",
        "month_start",
        *[keep_if(plausible[n], c(n)).alias(n) for n in INDICATORS],
        "shock_tarifa",
        valid_month.alias("dq_valid_year_month"),
        *[plausible[n].alias(check) for n, (_, check) in INDICATORS.items()],
        text.first_match(
            [
                (~parsing.is_month_key(c("year_month")), "INVALID_YEAR_MONTH"),
                (c("month_start") > this_month, "FUTURE_MONTH_EXCLUDED"),
                (missing, "MISSING_INDICATOR_TO_NULL"),
                (outlier, "OUTLIER_TO_NULL"),
            ],
            "VALID",
        ).alias("macro_dq_status"),
        *lineage(),
    )
