"""Plan prices as a type-2 dimension: each row is one price, valid in a closed date interval."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffbook.functions.dates import AsOf, active_flag, end_or_open, parse_date
from tariffbook.functions.numbers import money, not_negative
from tariffbook.functions.text import is_blank


def valid_plan_rows(raw: DataFrame) -> DataFrame:
    """Rows with a plan id and a price of zero or more. A dropped version leaves a gap in its plan."""
    price = F.col("price_per_month")
    kept = raw.filter(~is_blank(F.col("plan_id")) & money(price).isNotNull() & not_negative(price))
    return kept.withColumn("price_per_month", money(price))


def price_history(raw: DataFrame, as_of: AsOf = None) -> DataFrame:
    dated = valid_plan_rows(raw).select(
        "plan_id",
        "plan_tier",
        "price_per_month",
        parse_date(F.col("effective_date")).alias("effective_date"),
        end_or_open(F.col("end_date")).alias("end_date"),
    )
    return dated.withColumn("is_active", active_flag(F.col("end_date"), as_of))


def plan_summary(history: DataFrame) -> DataFrame:
    """One row per plan: its current price, number of versions, first and last effective date.

    The current price is that of the latest effective date, even a future one;
    equal dates go to the later end, then the higher price. As an aggregate it
    is combined before the shuffle, and tells Spark that plan ids are unique.
    """
    latest = F.max(F.struct("effective_date", "end_date", "price_per_month"))
    return history.groupBy("plan_id").agg(
        latest["price_per_month"].alias("current_price"),
        F.count(F.lit(1)).alias("versions"),
        F.min("effective_date").alias("first_effective"),
        F.max("effective_date").alias("last_effective"),
    )


def current_prices(history: DataFrame) -> DataFrame:
    return plan_summary(history).select("plan_id", "current_price")


def plan_keys(history: DataFrame) -> DataFrame:
    return history.select("plan_id").distinct()
