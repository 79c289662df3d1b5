"""Master table: derived columns of the priced fact and attributes of its subscriber."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffbook.functions.dates import AsOf, duration_days, is_long_term, month_key
from tariffbook.functions.numbers import difference_2dp
from tariffbook.operators.skew import lookup_join
from tariffbook.schemas import ENRICHED_SUBSCRIPTIONS

SUBSCRIBER_ATTRIBUTES = ["name", "email", "country", "age", "signup_date"]


def subscription_counts(priced: DataFrame) -> DataFrame:
    """Subscriptions per subscriber, combined before the shuffle (a window would put a subscriber in one task)."""
    return priced.groupBy("subscriber_id").agg(F.count("subscription_id").alias("total_subscriptions"))


def with_duration(df: DataFrame, as_of: AsOf = None) -> DataFrame:
    days = duration_days(F.col("subscription_start_date"), F.col("subscription_end_date"), as_of)
    return df.withColumn("duration_days", days).withColumn(
        "long_term_subscriber", is_long_term(F.col("duration_days"))
    )


def with_month(df: DataFrame) -> DataFrame:
    return df.withColumn("subscription_month", month_key(F.col("subscription_start_date")))


def with_price_variance(df: DataFrame) -> DataFrame:
    """Negative where the subscriber still pays a lower, older price."""
    variance = difference_2dp(F.col("actual_monthly_price"), F.col("current_price"))
    return df.withColumn("price_variance", variance)


def enrich(priced: DataFrame, subscribers: DataFrame, as_of: AsOf = None) -> DataFrame:
    """The 22 columns of the staged fact. Rows without a clean subscriber are dropped.

    The counts are attached to the subscribers first (both sides one row per
    key), so the fact is joined once and Spark is free to split a skewed
    subscriber there; a consumer that ignores ``total_subscriptions`` does not
    pay for them at all.
    """
    attributes = subscribers.select("subscriber_id", *SUBSCRIBER_ATTRIBUTES)
    counted = attributes.join(subscription_counts(priced), "subscriber_id", "left")
    derived = with_price_variance(with_month(with_duration(priced, as_of)))
    return lookup_join(derived, counted, "subscriber_id").select(*ENRICHED_SUBSCRIPTIONS.names)
