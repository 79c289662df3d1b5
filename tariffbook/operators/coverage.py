"""Days that no version of a plan covers, and days that several do.

Versions are swept in the order of their effective dates, with the latest end
seen so far. A plan's time is cut into buckets as for the price lookup; a bucket
knows the latest end of those before it from one row for each, so the versions of
one plan are swept by as many tasks as it has buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tariffbook.operators.plans import plan_summary
from tariffbook.operators.pricing import bucket_of, bucket_rule
from tariffbook.operators.skew import lookup_join, shuffled


def matchable(history: DataFrame) -> DataFrame:
    """Versions that cover a day at all: both bounds are known and in order."""
    return history.filter(F.col("effective_date") <= F.col("end_date"))


def bucketed(history: DataFrame) -> DataFrame:
    """Matchable versions once each, with the bucket of their effective date."""
    rule = bucket_rule(plan_summary(history)).drop("current_price")
    spans = lookup_join(matchable(history), shuffled(rule), "plan_id")
    bucket = bucket_of(F.col("effective_date")).alias("_bucket")
    return spans.select(*history.columns, bucket)


def swept(history: DataFrame) -> DataFrame:
    """Matchable versions with ``covered_to``, the latest end of the plan's versions before them."""
    versions = bucketed(history)
    earlier = Window.partitionBy("plan_id").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = versions.groupBy("plan_id", "_bucket").agg(F.max("end_date").alias("last_end"))
    carried = ends.select("plan_id", "_bucket", F.max("last_end").over(earlier).alias("_carried"))
    here = (
        Window.partitionBy("plan_id", "_bucket").orderBy("effective_date", "end_date", "price_per_month", "plan_tier")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    known = versions.join(shuffled(carried), ["plan_id", "_bucket"])
    return known.withColumn("covered_to", F.greatest("_carried", F.max("end_date").over(here))).drop("_carried")


def gaps_and_overlaps(history: DataFrame) -> DataFrame:
    """``plan_id, kind, first_day, last_day``: days between versions that none covers, and days of a version that one before it covers."""
    effective, end, covered = F.col("effective_date"), F.col("end_date"), F.col("covered_to")
    kind = F.when(effective > F.date_add(covered, 1), "gap").when(effective <= covered, "overlap")
    gap = kind == "gap"
    found = swept(history).filter(kind.isNotNull())
    return found.select(
        "plan_id",
        kind.alias("kind"),
        F.when(gap, F.date_add(covered, 1)).otherwise(effective).alias("first_day"),
        F.when(gap, F.date_sub(effective, 1)).otherwise(F.least(end, covered)).alias("last_day"),
    )


def without_overlaps(history: DataFrame) -> DataFrame:
    """The versions of plans of which no two cover the same day."""
    twice = gaps_and_overlaps(history).filter("kind = 'overlap'").select("plan_id").distinct()
    return lookup_join(history, shuffled(twice), "plan_id", "left_anti").select(*history.columns)
