"""Exact money and ratings."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tariffbook.schemas import MONEY, RATING


def money(c: Column) -> Column:
    """Exact amount from text or any numeric type; null if unreadable."""
    return c.try_cast(MONEY)


def not_negative(c: Column) -> Column:
    """The sign as given, before any rounding: a very small negative amount is negative."""
    return c.try_cast("double") >= 0


def rating(c: Column) -> Column:
    return c.try_cast(RATING)


def charge_or_zero(c: Column) -> Column:
    return F.coalesce(money(c), F.lit(0).cast(MONEY))


def sum_2dp(c: Column) -> Column:
    """Aggregate: exact sum, rounded half-up to two places; null if all inputs are null."""
    return F.round(F.sum(c), 2).cast("double")


def mean_2dp(c: Column) -> Column:
    """Aggregate: exact mean over non-null inputs, rounded half-up (away from zero) to two places.

    ``avg`` of a decimal rounds once to its own scale and a second rounding to
    two places may then tip over, so the hundredths come from one integer
    division: ``(sum + n / 200) div (n / 100)``. The sum's type leaves room for
    the half, or the addition would give up a decimal.
    """
    return ratio_2dp(F.sum(c), F.count(c))


def ratio_2dp(total: Column, n: Column) -> Column:
    """The mean of ``n`` values from their exact sum, as ``mean_2dp`` rounds it; null for none."""
    total = total.try_cast("decimal(37,10)")
    half, unit = n * F.lit(Decimal("0.005")), F.nullif(n * F.lit(Decimal("0.01")), F.lit(Decimal("0.00")))
    hundredths = F.call_function("div", F.abs(total) + half, unit)
    return (F.signum(total.cast("double")) * hundredths / F.lit(100.0)).cast("double")


def difference_2dp(left: Column, right: Column) -> Column:
    return F.round(left - right, 2)
