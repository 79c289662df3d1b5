"""Column types and file names shared by sources, operators and sinks."""

from __future__ import annotations

from pyspark.sql import types as T

# Exact numbers: sums do not depend on the order in which partitions arrive.
# Ten decimals are kept from the text to the sum; rounding comes last.
MONEY = T.DecimalType(28, 10)
RATING = T.DecimalType(18, 10)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_TEXT, _DATE, _INT, _LONG = T.StringType(), T.DateType(), T.IntegerType(), T.LongType()

# Raw zone: everything is read as text, so one malformed value costs one null
# and never changes the type of a column.
RAW_SUBSCRIBERS = _struct(
    subscriber_id=_TEXT, name=_TEXT, email=_TEXT, phone=_TEXT, country=_TEXT, signup_date=_TEXT, age=_TEXT,
)
RAW_PLANS = _struct(
    plan_id=_TEXT, plan_tier=_TEXT, price_per_month=_TEXT, effective_date=_TEXT, end_date=_TEXT,
)
RAW_SUBSCRIPTIONS = _struct(
    subscription_id=_TEXT, subscriber_id=_TEXT, plan_id=_TEXT, subscription_start_date=_TEXT,
    subscription_end_date=_TEXT, status=_TEXT, billing_country=_TEXT, monthly_charge=_TEXT,
    satisfaction_rating=_TEXT,
)

# Staged zone.
CLEAN_SUBSCRIBERS = _struct(
    subscriber_id=_TEXT, name=_TEXT, email=_TEXT, phone=_TEXT, country=_TEXT, signup_date=_DATE, age=_INT,
)
PLAN_PRICE_HISTORY = _struct(
    plan_id=_TEXT, plan_tier=_TEXT, price_per_month=MONEY, effective_date=_DATE, end_date=_DATE, is_active=_TEXT,
)
ENRICHED_SUBSCRIPTIONS = _struct(
    subscriber_id=_TEXT, plan_id=_TEXT, subscription_id=_TEXT, subscription_start_date=_DATE,
    subscription_end_date=_DATE, status=_TEXT, billing_country=_TEXT, monthly_charge=MONEY,
    satisfaction_rating=RATING, plan_tier=_TEXT, actual_monthly_price=MONEY, current_price=MONEY,
    total_subscriptions=_LONG, duration_days=_INT, long_term_subscriber=T.BooleanType(),
    subscription_month=_TEXT, price_variance=T.DecimalType(22, 2), name=_TEXT, email=_TEXT, country=_TEXT,
    age=_INT, signup_date=_DATE,
)

# Names of the three input files.
RAW_FILES = {
    "subscribers.csv": RAW_SUBSCRIBERS,
    "plans.csv": RAW_PLANS,
    "subscriptions.csv": RAW_SUBSCRIPTIONS,
}
