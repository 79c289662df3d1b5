"""Relational rules on rows the golden tables lack."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tariffbook.operators import marts, plans, pricing, profiling, rejects, subscribers, subscriptions
from tariffbook.operators.enrichment import enrich
from tariffbook.plans import jobs

AS_OF = date(2024, 12, 31)

RAW_SUBSCRIBER = "subscriber_id string, name string, email string, phone string, country string, signup_date string, age string"
RAW_PLAN = "plan_id string, plan_tier string, price_per_month string, effective_date string, end_date string"
RAW_SUBSCRIPTION = (
    "subscription_id string, subscriber_id string, plan_id string, subscription_start_date string, "
    "subscription_end_date string, status string, billing_country string, monthly_charge string, "
    "satisfaction_rating string"
)


def subscriber(id, email, signup, **other):
    row = {"name": "N", "phone": None, "country": "USA", "age": "30", **other}
    return (id, row["name"], email, row["phone"], row["country"], signup, row["age"])


def subscription(id, subscriber_id, plan_id, start, end=None, status="active", country="USA", charge="1", rating="4"):
    return (id, subscriber_id, plan_id, start, end, status, country, charge, rating)


def ids(df, column="subscriber_id"):
    return sorted(r[column] for r in df.collect())


@pytest.mark.parametrize(
    ("rows", "kept"),
    [
        ([("S1", "a@b.c", "2024-01-02"), ("S2", "a@b.c", "2024-01-01")], ["S2"]),
        ([("S1", "a@b.c", "2024-01-02"), ("S2", "a@b.c", None)], ["S2"]),
        ([("S1", "a@b.c", "2024-01-02"), ("S2", "a@b.c", "junk")], ["S2"]),
        ([("S2", "a@b.c", "2024-01-02"), ("S1", "a@b.c", "2024-01-02")], ["S1"]),
        ([("S1", "a@b.c", "2024-01-02"), ("S2", "A@b.c", "2024-01-01"), ("S3", " a@b.c", "2024-01-01")], ["S1", "S2", "S3"]),
        ([("S1", "a@b.c", "2024-01-02")] * 3, ["S1"]),
    ],
)
def test_earliest_per_email(spark, rows, kept):
    raw = spark.createDataFrame([subscriber(*r) for r in rows], RAW_SUBSCRIBER)
    assert ids(subscribers.clean_subscribers(raw)) == kept


def test_age_that_is_no_number_is_null(spark):
    raw = spark.createDataFrame([subscriber("S1", "a@b.c", None, age="old")], RAW_SUBSCRIBER)
    assert subscribers.clean_subscribers(raw).first().age is None


def history_of(spark, *rows):
    return plans.price_history(spark.createDataFrame(list(rows), RAW_PLAN), AS_OF)


def test_price_history(spark):
    history = history_of(
        spark,
        ("P1", "Basic", "0", "2024-01-01", "1/31/2024"),
        ("P1", "Basic", "2.5", "junk", "junk"),
        ("P1", "Basic", "-0.01", "1/1/2024", None),
        ("P1", "Basic", "free", "1/1/2024", None),
        ("\t", "Basic", "1", "1/1/2025", None),
        (" ", "Basic", "1", "1/1/2024", None),
    )
    assert set(map(tuple, history.collect())) == {
        ("\t", "Basic", Decimal("1.0000"), date(2025, 1, 1), date(9999, 12, 31), "Y"),
        ("P1", "Basic", Decimal("0.0000"), date(2024, 1, 1), date(2024, 1, 31), "N"),
        ("P1", "Basic", Decimal("2.5000"), None, None, "N"),
    }


def test_current_price_may_lie_in_the_future(spark):
    history = history_of(
        spark,
        ("P1", "Basic", "1", "1/1/2024", "12/31/2098"),
        ("P1", "Basic", "9", "1/1/2099", None),
        ("P1", "Basic", "5", "junk", None),
        ("P2", "Basic", "3", "1/1/2024", "2/1/2024"),
        ("P2", "Basic", "4", "1/1/2024", "3/1/2024"),
        ("P3", "Basic", "7", "junk", None),
    )
    prices = {r.plan_id: float(r.current_price) for r in plans.current_prices(history).collect()}
    assert prices == {"P1": 9.0, "P2": 4.0, "P3": 7.0}


@pytest.fixture(scope="module")
def small(spark):
    people = spark.createDataFrame(
        [subscriber("S1", "a@b.c", "2024-01-01"), subscriber("S2", "b@b.c", "2024-01-01"), subscriber("S3", "bad", None)],
        RAW_SUBSCRIBER,
    )
    prices = spark.createDataFrame(
        [
            ("P5", "Standard", "14.99", "1/1/2024", "3/31/2024"),
            ("P5", "Standard", "-5", "4/1/2024", "6/30/2024"),
            ("P5", "Standard", "15.99", "7/1/2024", None),
            ("P6", "Premium", "22.99", "1/1/2024", "2/28/2024"),
            ("P6", "Premium", "23.99", "3/1/2024", None),
            ("P7", "Basic", "5", "1/1/2024", "6/30/2024"),
            ("P7", "Basic", "6", "6/30/2024", None),
            ("P8", "Basic", "8", "1/1/2024", "junk"),
            ("P9", "Basic", "8", "2/1/2024", "1/1/2024"),
        ],
        RAW_PLAN,
    )
    facts = spark.createDataFrame(
        [
            subscription("gap", "S1", "P5", "5/15/2024"),
            subscription("leap", "S1", "P6", "2/29/2024"),
            subscription("first day", "S1", "P5", "1/1/2024"),
            subscription("last day", "S1", "P5", "3/31/2024"),
            subscription("before", "S1", "P5", "12/31/2023"),
            subscription("both", "S2", "P7", "6/30/2024"),
            subscription("unreadable end", "S2", "P8", "2/1/2024"),
            subscription("reversed", "S2", "P9", "1/15/2024"),
            subscription("no start", "S2", "P5", "junk"),
            subscription("no status", "S2", "P5", "1/1/2024", status=None),
            subscription("Capital", "S2", "P5", "2024-01-01", status="Cancelled"),
            subscription("cancelled", "S2", "P5", "1/1/2024", status="cancelled"),
            subscription("no subscriber", "S3", "P5", "1/1/2024"),
            subscription("null subscriber", None, "P5", "1/1/2024"),
            subscription("no plan", "S2", "PX", "1/1/2024"),
            subscription("null plan", "S2", None, "1/1/2024"),
            subscription("neither", "S9", "PX", "1/1/2024", status="cancelled"),
        ],
        RAW_SUBSCRIPTION,
    )
    return people, prices, facts, subscribers.clean_subscribers(people), plans.price_history(prices, AS_OF)


EXPECTED_PRICES = sorted(
    [
        ("gap", None, None), ("leap", None, None), ("first day", "Standard", 14.99), ("last day", "Standard", 14.99),
        ("before", None, None), ("both", "Basic", 5.0), ("both", "Basic", 6.0), ("unreadable end", None, None),
        ("reversed", None, None), ("no start", None, None), ("Capital", "Standard", 14.99),
    ],
    key=str,
)


@pytest.mark.parametrize("strategy", ["bucketed", "plain"])
def test_resolution(small, strategy):
    _, _, facts, people, history = small
    priced = pricing.resolve_prices(
        subscriptions.clean_subscriptions(facts, people, history), history, strategy=strategy
    )
    rows = [
        (r.subscription_id, r.plan_tier, r.actual_monthly_price and float(r.actual_monthly_price))
        for r in priced.collect()
    ]
    assert sorted(rows, key=str) == EXPECTED_PRICES
    assert len(ids(pricing.unresolved(priced), "subscription_id")) == 6


def test_unknown_strategy(small):
    with pytest.raises(ValueError, match="unknown strategy"):
        pricing.resolve_prices(small[2], small[4], strategy="magic")


def test_orphans_and_known(small):
    _, _, facts, people, history = small
    assert ids(subscriptions.orphan_subscribers(facts, people), "subscription_id") == [
        "neither", "no subscriber", "null subscriber",
    ]
    assert ids(subscriptions.orphan_plans(facts, history), "subscription_id") == ["neither", "no plan", "null plan"]
    assert subscriptions.with_known_subscriber(facts, people).count() == 14
    assert subscriptions.with_known_plan(facts, history).count() == 14
    assert subscriptions.orphan_plans(facts, history).columns == facts.columns


def test_enriched_both_ways(small):
    _, _, facts, people, history = small
    stepwise = enrich(
        pricing.resolve_prices(subscriptions.clean_subscriptions(facts, people, history), history), people, AS_OF
    )
    short = jobs.build_enriched(facts, people, history, AS_OF)
    rows = sorted(map(str, short.collect()))
    assert rows == sorted(map(str, stepwise.collect()))
    # Two versions cover one start day: two rows, and both are counted.
    totals = {r.subscriber_id: r.total_subscriptions for r in short.collect()}
    assert totals == {"S1": 5, "S2": 6}
    summary = {(r.billing_country, r.plan_tier): tuple(r)[2:] for r in marts.subscriber_summary(short).collect()}
    assert summary[("United States", None)] == (2, None, 4.0, 6)
    assert summary[("United States", "Basic")] == (1, 11.0, 4.0, 2)


def test_one_subscriber_id_under_two_emails(spark, small):
    _, _, facts, _, history = small
    twice = spark.createDataFrame(
        [subscriber("S1", "a@b.c", "2024-01-01"), subscriber("S1", "z@b.c", "2024-01-01")], RAW_SUBSCRIBER
    )
    people = subscribers.clean_subscribers(twice)
    assert subscriptions.with_known_subscriber(facts, people).count() == 5
    enriched = jobs.build_enriched(facts, people, history, AS_OF)
    assert enriched.count() == 10
    assert {r.total_subscriptions for r in enriched.collect()} == {5}


def test_rejects_account_for_every_row(small):
    people, prices, facts, clean_people, history = small
    by_rule = {(r.table, r.rule): r.rows for r in rejects.rejects_by_rule(*small).collect()}
    assert by_rule == {
        ("subscribers", "invalid_email"): 1,
        ("plans", "null_or_negative_price"): 1,
        ("subscriptions", "orphan_subscriber"): 3,
        ("subscriptions", "orphan_plan"): 2,
        ("subscriptions", "null_status"): 1,
        ("subscriptions", "cancelled"): 1,
    }
    kept = {
        "subscribers": clean_people.count(),
        "plans": history.count(),
        "subscriptions": subscriptions.clean_subscriptions(facts, clean_people, history).count(),
    }
    raw = {"subscribers": people.count(), "plans": prices.count(), "subscriptions": facts.count()}
    for name, total in raw.items():
        assert kept[name] + sum(n for (table, _), n in by_rule.items() if table == name) == total
    records = rejects.rejects(*small).groupBy("table", "rule").agg(F.sum("rows").alias("rows"))
    assert {(r.table, r.rule): r.rows for r in records.collect()} == by_rule


def test_copies_of_a_subscriber_are_rejected_one_by_one(spark, small):
    copies = spark.createDataFrame([subscriber("S1", "a@b.c", "2024-01-01")] * 5, RAW_SUBSCRIBER)
    found = rejects.rejects(copies, *small[1:]).filter("table = 'subscribers'").collect()
    assert [(r.record_id, r.rule, r.rows) for r in found] == [("S1", "duplicate_email", 4)]


def test_row_counts_and_observation(spark, small):
    people, prices, *_ = small
    counts = profiling.row_counts({"people": people, "prices": prices})
    assert sorted(map(tuple, counts.collect())) == [("people", 3), ("prices", 9)]
    watched, metrics = profiling.observed(prices, "prices", priced=F.count("price_per_month"))
    watched.collect()
    assert metrics.get == {"rows": 9, "priced": 9}


def test_distinct_content(spark):
    df = spark.createDataFrame([(3, "a"), (1, "b"), (2, "a"), (4, None)], "id long, text string")
    found = {(r.id, r.copies) for r in profiling.distinct_content(df, "text", "id").collect()}
    assert found == {(2, 2), (1, 1), (4, 1)}


def test_top_months(spark):
    rows = [("2024-01", "A", "x", 1.0), ("2024-01", "B", "x", None), ("2024-02", "A", "x", 1.0), ("2024-03", "A", "x", 2.0)]
    revenue = spark.createDataFrame(rows, "subscription_month string, billing_country string, plan_tier string, total_revenue double")
    assert [r.subscription_month for r in marts.top_months(revenue, 3).collect()] == ["2024-03", "2024-01", "2024-02"]
