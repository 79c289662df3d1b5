"""Which price held on the start date of each subscription."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffbook.operators.plans import plan_summary
from tariffbook.operators.skew import lookup_join, shuffled

# Fixed value: no bucket is shorter, however densely a plan's prices change.
LEAST_BUCKET_DAYS = 30


def bucket_rule(summary: DataFrame) -> DataFrame:
    """Adds ``bucket_days``: about the mean length of a plan's versions, so that a plan has as many buckets as versions."""
    span = F.datediff("last_effective", "first_effective")
    days = F.greatest(F.lit(LEAST_BUCKET_DAYS), F.ceil(span / F.col("versions")))
    return summary.select("plan_id", "current_price", "first_effective", "last_effective", days.alias("bucket_days"))


def bucket_of(day: Column) -> Column:
    """Join bucket of a day: how many of the plan's bucket lengths after its first effective date.

    Days after the plan's last effective date share that date's bucket:
    whatever version is valid then is also valid there.
    """
    since = F.datediff(F.least(day, F.col("last_effective")), F.col("first_effective"))
    return F.floor(since / F.col("bucket_days"))


def _bucketed_versions(history: DataFrame, summary: DataFrame) -> DataFrame:
    """Versions once per bucket they touch.

    Closed at the plan's last effective date, so an open end adds no buckets
    beyond it. Without overlaps this adds at most a row per version.
    Versions that can match nothing (a missing or reversed bound) are left out.
    """
    matchable = history.filter(F.col("effective_date") <= F.col("end_date"))
    rule = bucket_rule(summary).drop("current_price")
    spans = lookup_join(matchable, shuffled(rule), "plan_id")
    buckets = F.sequence(bucket_of(F.col("effective_date")), bucket_of(F.col("end_date")))
    return spans.select(
        "plan_id",
        F.explode(buckets).alias("_bucket"),
        "plan_tier",
        F.col("price_per_month").alias("actual_monthly_price"),
        "effective_date",
        "end_date",
    )


def _plain_versions(history: DataFrame) -> DataFrame:
    return history.select(
        "plan_id",
        "plan_tier",
        F.col("price_per_month").alias("actual_monthly_price"),
        "effective_date",
        "end_date",
    )


def resolve_prices(
    fact: DataFrame,
    history: DataFrame,
    *,
    at: str = "subscription_start_date",
    known_plans_only: bool = False,
    strategy: str = "bucketed",
) -> DataFrame:
    """Add ``plan_tier`` and ``actual_monthly_price`` valid at ``at``, and ``current_price``.

    A row in a gap of its plan keeps null tier and price; a row covered by two
    versions comes out twice. ``known_plans_only`` drops rows whose plan has no
    version at all, which saves a separate semi join.

    ``as_of`` is for histories without overlaps, where at most one version is
    valid: it finds the last version that began on or before each distinct day
    of a plan, and fails where it meets an overlap. ``bucketed`` joins on plan and bucket, so a plan with a large share of all
    versions and subscriptions is spread over its buckets, and no row is compared
    with more versions than touch its bucket. ``plain`` joins on the plan alone, for histories known to have few versions per plan.
    History and plans are never broadcast, as their size is not known before they are made.
    """
    summary = plan_summary(history)
    if strategy not in ("bucketed", "as_of", "plain"):
        raise ValueError(f"unknown strategy: {strategy!r}")
    looked_up = summary.select("plan_id", "current_price") if strategy == "plain" else bucket_rule(summary)
    with_plan = lookup_join(fact, shuffled(looked_up), "plan_id", "inner" if known_plans_only else "left")
    day = F.col(at)
    if strategy == "as_of":
        from tariffbook.operators.as_of import versions_on

        keyed = with_plan.withColumn("_bucket", bucket_of(day)).withColumn("_day", day)
        found = versions_on(keyed.select("plan_id", "_day", "_bucket").distinct(), history)
        priced = keyed.join(found, ["plan_id", "_day"], "left")
        return priced.select(*fact.columns, "plan_tier", "actual_monthly_price", "current_price")
    valid = day.between(F.col("effective_date"), F.col("end_date"))
    if strategy == "bucketed":
        keyed = with_plan.withColumn("_bucket", bucket_of(day))
        versions, keys = _bucketed_versions(history, summary), ["plan_id", "_bucket"]
    else:
        keyed, versions, keys = with_plan, _plain_versions(history), ["plan_id"]
    left, right = keyed.alias("fact"), shuffled(versions).alias("version")
    same_key = [F.col(f"fact.{k}") == F.col(f"version.{k}") for k in keys]
    joined = left.join(right, [*same_key, valid], "left")
    return joined.select(
        *(F.col(f"fact.{c}") for c in fact.columns), "plan_tier", "actual_monthly_price", "current_price"
    )


def unresolved(priced: DataFrame) -> DataFrame:
    """Rows for which no version was valid."""
    return priced.filter(F.col("actual_monthly_price").isNull())
