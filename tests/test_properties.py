"""Results do not depend on partitioning, row order or the way prices are looked up."""

import random
from collections import Counter
from datetime import date, timedelta

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tariffbook.operators import pricing
from tariffbook.plans import catalogue

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["subscriber_summary", "monthly_revenue", "clean_subscribers", "rejects_by_rule"])
def test_any_number_of_partitions(spark, name):
    results = []
    for partitions in ("1", "8", "64"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            results.append(Counter(map(tuple, catalogue.queries()[name](spark, SF_DIR).collect())))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] == results[2]


def test_any_row_order(spark):
    ordered = catalogue.Tables(spark, SF_DIR)
    shuffled = catalogue.Tables(spark, SF_DIR)
    for name, key in (("raw_subscribers", "email"), ("raw_plans", "effective_date"), ("raw_subscriptions", "status")):
        shuffled.__dict__[name] = getattr(ordered, name).repartition(13, key)
    for query in (catalogue.subscriber_summary, catalogue.dedup_earliest_signup, catalogue.current_prices):
        assert Counter(map(tuple, query(ordered).collect())) == Counter(map(tuple, query(shuffled).collect()))


DAY0 = date(2020, 1, 1)
day = st.integers(0, 400).map(lambda n: DAY0 + timedelta(days=n))
version = st.tuples(st.sampled_from("AB"), day, st.one_of(day, st.just(date(9999, 12, 31)), st.none()), st.integers(0, 9))
subscription = st.tuples(st.sampled_from("ABC"), st.one_of(day, st.none()))


@settings(max_examples=12, deadline=None, derandomize=True, database=None, suppress_health_check=list(HealthCheck))
@given(
    versions=st.lists(version, min_size=1, max_size=30),
    facts=st.lists(subscription, min_size=1, max_size=30),
)
def test_resolution_is_the_plain_range_join(spark, versions, facts):
    """Any overlaps, gaps, reversed or missing ends: all strategies equal brute force."""
    history = spark.createDataFrame(
        [(p, "T", price, start, end) for p, start, end, price in versions],
        "plan_id string, plan_tier string, price_per_month long, effective_date date, end_date date",
    )
    fact = spark.createDataFrame(
        [(i, p, d) for i, (p, d) in enumerate(facts)], "id long, plan_id string, subscription_start_date date"
    )
    brute = Counter()
    for i, (plan, start) in enumerate(facts):
        hits = [x for p, a, b, x in versions if p == plan and start and b and a <= start <= b]
        brute.update([(i, x) for x in hits] or [(i, None)])
    for strategy in ("bucketed", "plain"):
        priced = pricing.resolve_prices(fact, history, strategy=strategy)
        assert Counter((r.id, r.actual_monthly_price) for r in priced.collect()) == brute


def test_dense_overlapping_history(spark, tmp_path):
    """Thousands of overlapping versions of one plan, against DuckDB."""
    rng = random.Random(7)
    rows = []
    for i in range(4000):
        start = DAY0 + timedelta(days=rng.randrange(3000))
        rows.append(("hot" if i % 3 else f"p{i % 40}", "T", i, start, start + timedelta(days=rng.randrange(-2, 40))))
    facts = [(i, "hot" if i % 2 else f"p{i % 50}", DAY0 + timedelta(days=rng.randrange(-50, 3200))) for i in range(5000)]
    history = spark.createDataFrame(
        rows, "plan_id string, plan_tier string, price_per_month long, effective_date date, end_date date"
    )
    fact = spark.createDataFrame(facts, "id long, plan_id string, subscription_start_date date")
    history.write.parquet(str(tmp_path / "h"))
    fact.write.parquet(str(tmp_path / "f"))
    expected = duckdb.sql(f"""
        SELECT id, price_per_month FROM '{tmp_path}/f/*.parquet' f LEFT JOIN '{tmp_path}/h/*.parquet' h
        ON f.plan_id = h.plan_id AND subscription_start_date BETWEEN effective_date AND end_date""").fetchall()
    for strategy in ("bucketed", "plain"):
        priced = pricing.resolve_prices(fact, history, strategy=strategy)
        assert Counter((r.id, r.actual_monthly_price) for r in priced.collect()) == Counter(expected)
