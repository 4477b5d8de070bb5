"""Exact numbers: decimals, rounding integers, clamps and guarded ratios."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def amount(col: Column, scale: int = 2) -> Column:
    """``decimal(18, scale)``, half-up; NULL stays NULL."""
    return col.cast(f"decimal(18,{scale})")


def amount_or_zero(col: Column, scale: int = 2) -> Column:
    return amount(F.coalesce(col, F.lit(0)), scale)


def whole(col: Column) -> Column:
    """Rounds half-up to an integer, where a plain cast would cut off."""
    return col.cast("decimal(38,0)").cast("bigint")


def not_below_zero(col: Column) -> Column:
    return F.greatest(F.coalesce(col, F.lit(0)), F.lit(0))


def clamp(col: Column, high: int) -> Column:
    """Within 0 and ``high``; NULL counts as 0."""
    return F.least(not_below_zero(col), F.lit(high))


def positive_amount(col: Column, scale: int = 2) -> Column:
    return amount(not_below_zero(col), scale)


def positive_whole(col: Column) -> Column:
    return whole(not_below_zero(col))


def ratio(numerator: Column, denominator: Column, scale: int = 4) -> Column:
    """Quotient rounded to ``scale``; NULL unless the denominator is positive."""
    return amount(F.when(denominator > 0, numerator / denominator), scale)


def percentage(part: Column, total: Column) -> Column:
    """``100 * part / total`` of two counts to two decimals; NULL for an empty total."""
    exact = "decimal(20,0)"
    share = (F.lit(100).cast("decimal(3,0)") * part.cast(exact)) / F.nullif(total, F.lit(0)).cast(exact)
    return F.round(share, 2).cast("decimal(18,2)")


# Fixed value: bits of the lower half of a whole number.
_LOWER_BITS = 32


def halves(col: Column, scale: int) -> tuple[Column, Column]:
    """A decimal below 2^63 units of its last place in two whole numbers, of which some two billion can be added as such.

    Sums of wide decimals are objects that every row makes anew; these are plain numbers, and as exact.
    """
    units = (col * F.lit(10**scale)).cast("bigint")
    return F.shiftright(units, _LOWER_BITS), units.bitwiseAND(F.lit(2**_LOWER_BITS - 1))


def from_halves(upper: Column, lower: Column, scale: int) -> Column:
    """The sum of decimals from the sums of their ``halves``."""
    units = upper.cast("decimal(20,0)") * F.lit(Decimal(2**_LOWER_BITS)) + lower.cast("decimal(20,0)")
    return units * F.lit(Decimal(1).scaleb(-scale))


def sum_given(name: str, how: str = "sum") -> Column:
    """A sum, or an average, which rows without the value do not touch; the result is that of all rows."""
    return F.expr(f"{how}(`{name}`) FILTER (WHERE `{name}` IS NOT NULL)")


def close_to(left: Column, right: Column, tolerance: str) -> Column:
    return F.abs(left - right) <= F.lit(Decimal(tolerance))


def discounted_amount(price: Column, discount: Column, scale: int = 2) -> Column:
    """The discount taken off a price, as a negative amount.

    Binary doubles are first read as the decimals they stand for, so the
    product is exact before it is rounded.
    """
    product = price.cast("decimal(18,4)") * discount.cast("decimal(18,4)")
    return (-product).cast(f"decimal(16,{scale})")
