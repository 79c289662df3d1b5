"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (tables), ``BENCH_CPUS`` (local cores), ``BENCH_RUNS`` (timed
runs per query, the median counts). One untimed run per query comes first.
Results go to a sink that drops them, so every column and row is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tariffbook.plans import catalogue  # noqa: E402

HEADLINE = [
    "normalise_phone",
    "phone_from_documents",
    "email_from_documents",
    "plan_price_history",
    "current_prices",
    "dedup_earliest_signup",
    "clean_subscribers",
    "clean_subscriptions",
    "rejects_by_rule",
    "scd_price_resolution",
    "scd_price_resolution_bucketed",
    "price_variance",
    "total_subscriptions",
    "enriched_subscriptions",
    "subscriber_summary",
    "monthly_revenue",
    "monthly_revenue_top_n",
    "content_hash_dedup",
]


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session()
    cpus = spark.sparkContext.defaultParallelism
    queries = catalogue.queries()

    def timed(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        timed(name)
        seconds[name] = round(statistics.median(timed(name) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median warm query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": cpus,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
