"""Reporting tables over the enriched fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffbook.functions.numbers import mean_2dp, sum_2dp

# The names of the output columns below are fixed values.


def subscriber_summary(enriched: DataFrame) -> DataFrame:
    """Per billing country and tier. Rows without a price form a group of tier null and revenue null."""
    keys = ["billing_country", "plan_tier"]
    return (
        enriched.groupBy(*keys)
        .agg(
            F.count_distinct("subscriber_id").alias("num_subscribers"),
            sum_2dp(F.col("actual_monthly_price")).alias("total_revenue"),
            mean_2dp(F.col("satisfaction_rating")).alias("avg_satisfaction"),
            F.count("subscription_id").alias("num_subscriptions"),
        )
        .orderBy(*keys)
    )


def monthly_revenue(enriched: DataFrame) -> DataFrame:
    """Per start month, billing country and tier, at the prices that held on the start date."""
    keys = ["subscription_month", "billing_country", "plan_tier"]
    return (
        enriched.groupBy(*keys)
        .agg(
            sum_2dp(F.col("actual_monthly_price")).alias("total_revenue"),
            F.count("subscription_id").alias("num_active_subscriptions"),
            mean_2dp(F.col("actual_monthly_price")).alias("avg_price_in_effect"),
        )
        .orderBy(*keys)
    )


def top_months(revenue: DataFrame, n: int = 50) -> DataFrame:
    """Report head: the ``n`` groups of highest revenue, ties in key order."""
    return revenue.orderBy(
        F.col("total_revenue").desc_nulls_last(), "subscription_month", "billing_country", "plan_tier"
    ).limit(n)


def preview(report: DataFrame, n: int = 50) -> DataFrame:
    """Report head in the order of its columns, which begin with its keys."""
    return report.orderBy(*report.columns).limit(n)
