"""Data-quality checks. Each returns the rows that fail it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.functions.keys import packed_digest
from silverlode.operators.latest import EXTRACTED_AT


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Repeated values and how often they occur; NULLs are not compared."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.filter(F.col("n_records") > 1)


def _repeated(df: DataFrame, column: str) -> DataFrame:
    """One row per failure of ``unique``, of which only the number counts: digests move as 16 bytes instead of 32 characters."""
    if not (column.endswith("_key") and isinstance(df.schema[column].dataType, T.StringType)):
        return unique(df, column)
    counts = df.filter(F.col(column).isNotNull()).groupBy(packed_digest(column).alias(column)).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.filter(F.col("n_records") > 1)


def accepted_values(df: DataFrame, column: str, values: Iterable[object]) -> DataFrame:
    return df.filter(~F.col(column).isin(*values))


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Rows whose reference is not found; a missing reference is no failure."""
    known = parent.select(F.col(field).alias(column)).filter(F.col(column).isNotNull())
    return child.filter(F.col(column).isNotNull()).join(known, column, "left_anti").select(*child.columns)


def between(df: DataFrame, column: str, low: object, high: object) -> DataFrame:
    return df.filter(~F.col(column).between(low, high))


def discount_is_reasonable(order_item: DataFrame) -> DataFrame:
    """Items whose discount is larger than their price."""
    return order_item.filter(F.abs("item_discount_amount") > F.col("extended_price")).select(
        "order_key", "line_number", "extended_price", "item_discount_amount"
    )


@dataclass(frozen=True)
class Check:
    """One test of one column."""

    model: str
    column: str
    kind: str
    values: tuple = ()
    parent: str | None = None

    def failure(self) -> Column | None:
        """Condition of a failing row, for the kinds that look at single rows."""
        c = F.col(self.column)
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "accepted_values":
            return ~c.isin(*self.values)
        if self.kind == "between":
            return ~c.between(*self.values)
        return None


def _counted(check: Check, failing: DataFrame) -> DataFrame:
    return failing.agg(F.count(F.lit(1)).alias("failures")).select(*_labels(check), "failures")


def _labels(check: Check) -> list[Column]:
    return [
        F.lit(check.model).alias("model"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.kind).alias("check_name"),
    ]


def observed(df: DataFrame, checks: Iterable[Check]) -> tuple[DataFrame, Callable[[], dict[Check, int]]]:
    """The same rows, and a function that gives the failures of the single-row checks once the rows have been written.

    Spark counts them as the rows go by, so they cost no scan of their own.
    """
    rowwise = [c for c in checks if c.failure() is not None]
    if not rowwise:
        return df, dict
    seen = Observation()
    watched = df.observe(seen, *[F.count_if(F.coalesce(c.failure(), F.lit(False))).alias(f"c{i}") for i, c in enumerate(rowwise)])
    return watched, lambda: {c: seen.get[f"c{i}"] for i, c in enumerate(rowwise)}


def run_suite(
    tables: Mapping[str, DataFrame], checks: Iterable[Check], counted: Mapping[Check, int] | None = None
) -> DataFrame:
    """Failures per check, as one DataFrame.

    All single-row checks of a table share one pass over it, but for those that are ``counted`` already. Uniqueness costs a
    shuffle of the column, a relationship one join.
    """
    counted = counted or {}
    parts = []
    known = [c for c in checks if c in counted]
    if known:
        spark = tables[known[0].model].sparkSession
        rows = [(c.model, c.column, c.kind, counted[c]) for c in known]
        parts.append(spark.createDataFrame(rows, "model string, column_name string, check_name string, failures long"))
    checks = [c for c in checks if c not in counted]
    for model in dict.fromkeys(c.model for c in checks):
        rowwise = [c for c in checks if c.model == model and c.failure() is not None]
        if rowwise:
            counts = tables[model].agg(*[F.count_if(c.failure()).alias(f"c{i}") for i, c in enumerate(rowwise)])
            entries = [F.struct(*_labels(c), F.col(f"c{i}").alias("failures")) for i, c in enumerate(rowwise)]
            parts.append(counts.select(F.inline(F.array(*entries))))
    for c in checks:
        if c.kind == "unique":
            parts.append(_counted(c, _repeated(tables[c.model], c.column)))
        if c.kind == "relationships":
            parts.append(_counted(c, relationships(tables[c.model], c.column, tables[c.parent], c.values[0])))
    return reduce(DataFrame.unionByName, parts)


def freshness(
    sources: Mapping[str, DataFrame],
    now: dt.datetime,
    max_age: Mapping[str, dt.timedelta],
    loaded_at: str = EXTRACTED_AT,
) -> DataFrame:
    """Newest load of each source, its age, and whether that is too old."""
    moment = F.lit(now.isoformat(sep=" ")).cast("timestamp")
    age = F.unix_seconds(moment) - F.unix_seconds("max_loaded_at")
    parts = [
        df.agg(F.max(F.col(loaded_at).cast("timestamp")).alias("max_loaded_at")).select(
            F.lit(name).alias("source_name"),
            "max_loaded_at",
            age.alias("age_seconds"),
            F.when(age <= max_age[name].total_seconds(), "pass").otherwise("warn").alias("status"),
        )
        for name, df in sources.items()
    ]
    return reduce(DataFrame.unionByName, parts)
