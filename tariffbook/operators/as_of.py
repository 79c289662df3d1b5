"""The version of a plan that holds on a day, by carrying the last one on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tariffbook.operators.coverage import swept
from tariffbook.operators.skew import shuffled


def versions_on(days: DataFrame, history: DataFrame) -> DataFrame:
    """``plan_id, _day, plan_tier, actual_monthly_price`` for distinct ``plan_id, _day, _bucket``; no price in a gap.

    Days and versions of one bucket of a plan meet in one task; what began in
    earlier buckets comes as one row for each bucket, carried on from the last
    one that has a version. So a plan is spread over its buckets, however many of
    the days and versions are its own. A version that begins before one ahead of
    it has ended is an error, since only one of them would be found.
    """
    overlap = F.raise_error(F.concat(F.lit("versions overlap in plan "), "plan_id")).cast("date")
    started = F.when(F.col("covered_to") >= F.col("effective_date"), overlap).otherwise(F.col("effective_date"))
    version = F.struct(F.col("end_date").alias("end"), "plan_tier", F.col("price_per_month").alias("price"))
    versions = swept(history).select("plan_id", "_bucket", started.alias("_day"), version.alias("_version"))

    asked = days.filter("_day IS NOT NULL AND _bucket IS NOT NULL").select("plan_id", "_bucket", "_day")
    last = versions.groupBy("plan_id", "_bucket").agg(F.max_by("_version", "_day").alias("_last"))
    nothing = F.lit(None).cast(last.schema["_last"].dataType).alias("_last")
    buckets = last.unionByName(asked.select("plan_id", "_bucket", nothing)).groupBy("plan_id", "_bucket")
    earlier = Window.partitionBy("plan_id").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = buckets.agg(F.first("_last", ignorenulls=True).alias("_last")).select(
        "plan_id", "_bucket", F.last("_last", ignorenulls=True).over(earlier).alias("_carried")
    )

    none = F.lit(None).cast(versions.schema["_version"].dataType).alias("_version")
    both = versions.withColumn("_asked", F.lit(False)).unionByName(asked.select("*", none, F.lit(True).alias("_asked")))
    here = Window.partitionBy("plan_id", "_bucket").orderBy("_day", "_asked")
    held = both.join(shuffled(carried), ["plan_id", "_bucket"]).withColumn(
        "_held", F.coalesce(F.last("_version", ignorenulls=True).over(here), "_carried")
    )
    valid = F.col("_day") <= F.col("_held.end")
    return held.filter("_asked").select(
        "plan_id", "_day", F.when(valid, F.col("_held.plan_tier")).alias("plan_tier"),
        F.when(valid, F.col("_held.price")).alias("actual_monthly_price"),
    )
