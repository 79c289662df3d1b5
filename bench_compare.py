"""Fixed comparisons behind the design: one JSON line of median seconds.

Same settings as ``bench.py``. Native expressions against row-at-a-time Python
functions, price lookup by strategy with and without broadcast, the summary at
several numbers of shuffle partitions.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bench import session
from tariffbook.functions.text import is_valid_email, normalise_phone
from tariffbook.plans import catalogue
from tariffbook.plans.jobs import priced_subscriptions


def _same(value):
    return value


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session()
    tables = catalogue.Tables(spark, sf_dir)

    def seconds(df: DataFrame) -> float:
        def once() -> float:
            start = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            return time.perf_counter() - start

        once()
        return round(statistics.median(once() for _ in range(runs)), 3)

    python = F.udf(_same, "string")  # what any Python function costs before it does anything
    # Texts of the fact's size: one phone and one email per line.
    texts = tables.source("lineitem").selectExpr(
        "concat('(555) ', l_orderkey % 900 + 100, '.', l_partkey % 9000 + 1000) AS phone",
        "concat('u', l_orderkey, '@mail.example.com') AS email",
    )
    result = {
        "phone native": seconds(texts.select(normalise_phone(F.col("phone")))),
        "phone through Python, unchanged": seconds(texts.select(python("phone"))),
        "email native": seconds(texts.select(is_valid_email(F.col("email")))),
        "email through Python, unchanged": seconds(texts.select(python("email"))),
    }
    limits = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for label, threshold in (("broadcast", "10MB"), ("shuffle", "-1")):
        for limit in limits:
            spark.conf.set(limit, threshold)
        for strategy in ("plain", "bucketed"):
            priced = priced_subscriptions(tables.raw_subscriptions, tables.history, strategy)
            result[f"prices {strategy} {label}"] = seconds(priced)
    for limit in limits:
        spark.conf.unset(limit)
    for partitions in ("1", "8", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        result[f"summary {partitions} partitions"] = seconds(catalogue.queries()["subscriber_summary"](spark, sf_dir))
    spark.stop()
    print(json.dumps({"unit": "sec", "runs": runs, "comparisons": result}))


if __name__ == "__main__":
    main()
