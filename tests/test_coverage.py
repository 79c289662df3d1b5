"""Gaps, overlaps and as-of prices against a count of versions day by day."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tariffbook.operators import coverage, pricing
from tariffbook.schemas import PLAN_PRICE_HISTORY

DAY = date(2015, 1, 1)
END = date(9999, 12, 31)


def history_of(spark, rows):
    """Rows (plan, first day, last day, price), days as numbers; a last day of None is open."""
    from decimal import Decimal

    day = lambda n: None if n is None else DAY + timedelta(n)
    made = [(p, f"tier{x}", Decimal(x), day(a), END if b is None else day(b), "Y") for p, a, b, x in rows]
    return spark.createDataFrame(made, PLAN_PRICE_HISTORY)


def made_versions(seed, overlaps):
    pick = random.Random(seed)
    rows = []
    for plan in range(30):
        at = pick.randrange(50)
        for k in range(pick.randrange(1, 60) if plan else 900):
            size = pick.choice([1, 1, 5, 40, 200]) if plan else 1 + k % 3
            rows.append((f"P{plan}", at, at + size - 1, len(rows)))
            at += size + pick.choice([0, 0, 0, 1, 30]) - (pick.choice([0, 0, 3, 60]) if overlaps else 0)
            at = max(at, 0)
        if pick.random() < 0.3:
            rows.append((f"P{plan}", at, None, len(rows)))
    return [*rows, ("P1", 70, 60, -1)]  # one that covers nothing


def covered(rows):
    """How many versions cover each day, from a plan's first to its last begin or bounded end."""
    out = {}
    for plan, a, b, _ in rows:
        if b is None or b >= a:
            days = out.setdefault(plan, {})
            for day in range(a, min(20000, 20000 if b is None else b + 1)):
                days[day] = days.get(day, 0) + 1
    return out


@pytest.mark.parametrize("overlaps", [False, True])
def test_sweep(spark, overlaps):
    rows = made_versions(3, overlaps)
    found = coverage.gaps_and_overlaps(history_of(spark, rows)).collect()
    days = {"gap": {}, "overlap": {}}
    for r in found:
        first, last = (r["first_day"] - DAY).days, min((r["last_day"] - DAY).days, 19999)
        assert first <= last
        own = days[r["kind"]].setdefault(r["plan_id"], [])
        own.extend(range(first, last + 1))
    for plan, counts in covered(rows).items():
        span = range(min(counts), max(counts) + 1)
        assert sorted(days["gap"].get(plan, [])) == [d for d in span if d not in counts]
        assert set(days["overlap"].get(plan, [])) == {d for d in span if counts.get(d, 0) > 1}
    assert bool(days["overlap"]) == overlaps
    kept = {r["plan_id"] for r in coverage.without_overlaps(history_of(spark, rows)).select("plan_id").distinct().collect()}
    assert kept == {p for p, counts in covered(rows).items() if max(counts.values()) == 1}


def facts_of(spark):
    days = spark.range(0, 40_000, 1, 4).selectExpr(
        "id AS subscription_id", "concat('P', if(id % 3 = 0, 0, id % 32)) AS plan_id",
        "CASE WHEN id % 97 = 0 THEN null ELSE date_add(DATE '2014-12-01', cast(id % 2500 AS int)) END AS subscription_start_date",
    )
    return days.unionAll(days.limit(20))


@pytest.mark.parametrize("known", [False, True])
def test_as_of_equals_the_range_join(spark, known):
    history = history_of(spark, made_versions(5, False))
    rows = [
        sorted(map(str, pricing.resolve_prices(facts_of(spark), history, known_plans_only=known, strategy=s).collect()))
        for s in ("as_of", "plain")
    ]
    assert rows[0] == rows[1]
    assert sum("actual_monthly_price=None" in r for r in rows[0]) > 1000


def test_as_of_refuses_overlaps(spark):
    history = history_of(spark, [("P1", 0, 10, 1), ("P1", 10, 20, 2)])
    with pytest.raises(Exception, match="versions overlap in plan P1"):
        pricing.resolve_prices(facts_of(spark), history, strategy="as_of").collect()


def test_a_hot_plan_is_spread_over_its_buckets(spark):
    """The windows part a plan by bucket: the largest holds few of the versions and of the days."""
    history = history_of(spark, made_versions(5, False))
    sizes = coverage.bucketed(history).where("plan_id = 'P0'").groupBy("_bucket").count()
    most, buckets = sizes.agg(F.max("count"), F.count("*")).first()
    assert buckets > 40
    assert most < 40


def test_no_versions(spark):
    nothing = history_of(spark, [("P1", 5, 4, 1)])
    assert coverage.gaps_and_overlaps(nothing).count() == 0
    priced = pricing.resolve_prices(facts_of(spark), nothing, strategy="as_of")
    assert priced.where("actual_monthly_price IS NULL").count() == facts_of(spark).count()
