"""The marts as sums that can be added and taken back.

A state holds per group exact sums and counts, and for the distinct subscribers
of a group one row for each with the number of its rows. States of parts of the
fact add up to that of the whole in any order, and a part that is withdrawn is
subtracted, so a delivery touches its own groups only. Rows whose counts have
come back to zero go. Each merge is one aggregate, combined before its shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffbook.functions.numbers import ratio_2dp

SUMMARY_KEYS = ["billing_country", "plan_tier", "subscriber_id"]
REVENUE_KEYS = ["subscription_month", "billing_country", "plan_tier"]
# Sums keep the scale of amounts and ratings and leave the other digits to the number of rows.
_WIDE = "decimal(38,10)"
_COUNTS = ["rows", "subscriptions", "prices", "ratings"]
_SUMS = ["price_sum", "rating_sum"]


def _state(fact: DataFrame, keys: list[str]) -> DataFrame:
    price, rating = F.col("actual_monthly_price"), F.col("satisfaction_rating")
    counts = [F.lit(1), F.col("subscription_id"), price, rating]
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast(_WIDE).alias(name) for name, c in zip(_SUMS, (price, rating))]
    return fact.groupBy(*keys).agg(*(F.count(c).alias(name) for name, c in zip(_COUNTS, counts)), *sums)


def summary_state(fact: DataFrame) -> DataFrame:
    """State of ``marts.subscriber_summary``."""
    return _state(fact, SUMMARY_KEYS)


def revenue_state(fact: DataFrame) -> DataFrame:
    """State of ``marts.monthly_revenue``."""
    return _state(fact, REVENUE_KEYS)


def _signed(state: DataFrame, keys: list[str], sign: int) -> DataFrame:
    return state.select(*keys, *((F.col(c) * sign).cast(kind).alias(c) for c, kind in state.dtypes if c not in keys))


def merged(keys: list[str], added: list[DataFrame], taken_back: list[DataFrame] = ()) -> DataFrame:
    """The state of all that ``added`` states were made of, without what those ``taken_back`` were made of."""
    parts = [_signed(s, keys, 1) for s in added] + [_signed(s, keys, -1) for s in taken_back]
    every = reduce(DataFrame.unionByName, parts)
    sums = [F.sum(c).cast("bigint").alias(c) for c in _COUNTS] + [F.sum(c).cast(_WIDE).alias(c) for c in _SUMS]
    return every.groupBy(*keys).agg(*sums).filter("rows <> 0")


def _total(name: str, n: Column) -> Column:
    """A rounded sum of the state, null where nothing was summed."""
    return F.when(n > 0, F.round(F.sum(name), 2).cast("double"))


def subscriber_summary(state: DataFrame) -> DataFrame:
    """As ``marts.subscriber_summary`` of the rows the state was made of."""
    keys = SUMMARY_KEYS[:2]
    prices, ratings = F.sum("prices"), F.sum("ratings")
    return state.groupBy(*keys).agg(
        F.count("subscriber_id").alias("num_subscribers"),
        _total("price_sum", prices).alias("total_revenue"),
        ratio_2dp(F.sum("rating_sum"), ratings).alias("avg_satisfaction"),
        F.sum("subscriptions").alias("num_subscriptions"),
    ).orderBy(*keys)


def monthly_revenue(state: DataFrame) -> DataFrame:
    """As ``marts.monthly_revenue`` of the rows the state was made of."""
    prices = F.sum("prices")
    return state.groupBy(*REVENUE_KEYS).agg(
        _total("price_sum", prices).alias("total_revenue"),
        F.sum("subscriptions").alias("num_active_subscriptions"),
        ratio_2dp(F.sum("price_sum"), prices).alias("avg_price_in_effect"),
    ).orderBy(*REVENUE_KEYS)
