"""Subscription fact: typed columns, foreign keys that exist, no cancelled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffbook.functions.dates import parse_date
from tariffbook.functions.numbers import charge_or_zero, rating
from tariffbook.functions.text import normalise_country
from tariffbook.operators.plans import plan_keys
from tariffbook.operators.skew import lookup_join, shuffled


def fill_monthly_charge(raw: DataFrame) -> DataFrame:
    return raw.withColumn("monthly_charge", charge_or_zero(F.col("monthly_charge")))


def parse_subscription_dates(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {c: parse_date(F.col(c)) for c in ("subscription_start_date", "subscription_end_date")}
    )


def type_subscriptions(raw: DataFrame) -> DataFrame:
    typed = parse_subscription_dates(fill_monthly_charge(raw))
    return typed.withColumn("satisfaction_rating", rating(F.col("satisfaction_rating")))


def not_cancelled(df: DataFrame) -> DataFrame:
    """Exactly ``cancelled`` goes, and so does a missing status (the comparison is null)."""
    return df.filter(F.col("status") != "cancelled")


def orphan_subscribers(df: DataFrame, subscribers: DataFrame) -> DataFrame:
    return df.join(subscribers.select("subscriber_id"), "subscriber_id", "left_anti")


def with_known_subscriber(df: DataFrame, subscribers: DataFrame) -> DataFrame:
    """A semi join: an id that occurs under two emails does not multiply the fact here."""
    return df.join(subscribers.select("subscriber_id"), "subscriber_id", "left_semi")


def orphan_plans(df: DataFrame, history: DataFrame) -> DataFrame:
    return lookup_join(df, shuffled(plan_keys(history)), "plan_id", "left_anti")


def with_known_plan(df: DataFrame, history: DataFrame) -> DataFrame:
    return lookup_join(df, shuffled(plan_keys(history)), "plan_id", "left_semi")


def normalise_billing_country(df: DataFrame) -> DataFrame:
    return df.withColumn("billing_country", normalise_country(F.col("billing_country")))


def clean_subscriptions(raw: DataFrame, subscribers: DataFrame, history: DataFrame) -> DataFrame:
    known = with_known_plan(with_known_subscriber(type_subscriptions(raw), subscribers), history)
    return normalise_billing_country(not_cancelled(known))
