"""What the cleaning rules dropped. Each dropped row counts once, under the first rule it fails."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffbook.functions.numbers import money, not_negative
from tariffbook.functions.text import is_blank, is_valid_email
from tariffbook.operators.plans import plan_keys
from tariffbook.operators.skew import lookup_join, shuffled


def _outcome(id_column: str, rule: Column, rows: int = 1) -> list[Column]:
    return [F.col(id_column).cast("string").alias("record_id"), rule.alias("rule"), F.lit(rows).alias("rows")]


def _subscriber_outcomes(raw: DataFrame, kept: DataFrame) -> DataFrame:
    """All rows with the rule they would fail, and the kept (clean) rows again with a minus.

    Every valid row is first taken for a duplicate; the kept ones cancel out in
    the sum. So copies of a row are told apart without numbering them.
    """
    rule = F.when(is_valid_email(F.col("email")), "duplicate_email").otherwise("invalid_email")
    return raw.select(*_outcome("subscriber_id", rule)).union(
        kept.select(*_outcome("subscriber_id", F.lit("duplicate_email"), -1))
    )


def _plan_outcomes(raw: DataFrame) -> DataFrame:
    price = money(F.col("price_per_month"))
    rule = F.when(is_blank(F.col("plan_id")), "blank_plan_id").when(
        price.isNull() | ~not_negative(F.col("price_per_month")), "null_or_negative_price"
    )
    return raw.select(*_outcome("plan_id", rule)).filter(F.col("rule").isNotNull())


def _subscription_rule(known_subscriber: Column, known_plan: Column, status: Column) -> Column:
    return (
        F.when(known_subscriber.isNull(), "orphan_subscriber")
        .when(known_plan.isNull(), "orphan_plan")
        .when(status.isNull(), "null_status")
        .when(status == "cancelled", "cancelled")
    )


def _marked(keys: DataFrame, marker: str) -> DataFrame:
    return keys.withColumn(marker, F.lit(True))


def _with_marks(raw: DataFrame, subscribers: DataFrame) -> DataFrame:
    ids = _marked(subscribers.select("subscriber_id").distinct(), "_known_subscriber")
    return lookup_join(raw, ids, "subscriber_id", "left")


_SUBSCRIPTION_RULE = ("_known_subscriber", "_known_plan", "status")


def _subscription_outcomes(raw: DataFrame, subscribers: DataFrame, history: DataFrame) -> DataFrame:
    marked = lookup_join(
        _with_marks(raw, subscribers), shuffled(_marked(plan_keys(history), "_known_plan")), "plan_id", "left"
    )
    rule = _subscription_rule(*(F.col(c) for c in _SUBSCRIPTION_RULE))
    return marked.select(*_outcome("subscription_id", rule)).filter(F.col("rule").isNotNull())


def _subscription_totals(raw: DataFrame, subscribers: DataFrame, history: DataFrame) -> DataFrame:
    """Same outcomes without ids: the fact is added up per plan before it meets the plan keys."""
    per_plan = (
        _with_marks(raw, subscribers)
        .groupBy("_known_subscriber", "plan_id", "status")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    marked = per_plan.join(shuffled(_marked(plan_keys(history), "_known_plan")), "plan_id", "left")
    rule = _subscription_rule(*(F.col(c) for c in _SUBSCRIPTION_RULE))
    return marked.select(rule.alias("rule"), "rows").filter(F.col("rule").isNotNull())


def _summed(outcomes: dict[str, DataFrame], *keys: str) -> DataFrame:
    tagged = [df.select(F.lit(name).alias("table"), *keys, F.col("rows").cast("long")) for name, df in outcomes.items()]
    everything = reduce(DataFrame.union, tagged)
    return everything.groupBy("table", *keys).agg(F.sum("rows").alias("rows")).filter("rows > 0")


def rejects(
    raw_subscribers: DataFrame,
    raw_plans: DataFrame,
    raw_subscriptions: DataFrame,
    subscribers: DataFrame,
    history: DataFrame,
) -> DataFrame:
    """``table, record_id, rule, rows``: dropped records with the number of rows dropped of each."""
    return _summed(
        {
            "subscribers": _subscriber_outcomes(raw_subscribers, subscribers),
            "plans": _plan_outcomes(raw_plans),
            "subscriptions": _subscription_outcomes(raw_subscriptions, subscribers, history),
        },
        "record_id",
        "rule",
    )


def rejects_by_rule(
    raw_subscribers: DataFrame,
    raw_plans: DataFrame,
    raw_subscriptions: DataFrame,
    subscribers: DataFrame,
    history: DataFrame,
) -> DataFrame:
    """``table, rule, rows``."""
    return _summed(
        {
            "subscribers": _subscriber_outcomes(raw_subscribers, subscribers),
            "plans": _plan_outcomes(raw_plans),
            "subscriptions": _subscription_totals(raw_subscriptions, subscribers, history),
        },
        "rule",
    )
