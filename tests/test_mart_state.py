"""Marts from states against marts from rows: after A and B, after B is taken back, in any grouping."""

from collections import Counter

import pytest

from tariffbook.functions.text import trim_strings
from tariffbook.operators import mart_state, marts
from tariffbook.plans import catalogue

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """Three parts of the fact, with groups of their own and shared ones."""
    path = str(tmp_path_factory.mktemp("state") / "fact")
    trim_strings(catalogue.Tables(spark, SF_DIR).enriched).write.parquet(path)
    fact = spark.read.parquet(path)
    return [fact.where(f"pmod(xxhash64(subscription_id), 3) = {k}") for k in (0, 1)] + [fact.where("subscription_month >= '1998-01'")]


def rows(df):
    return Counter(tuple(r) for r in df.collect())


KINDS = [
    (mart_state.summary_state, mart_state.SUMMARY_KEYS, mart_state.subscriber_summary, marts.subscriber_summary),
    (mart_state.revenue_state, mart_state.REVENUE_KEYS, mart_state.monthly_revenue, marts.monthly_revenue),
]


@pytest.mark.parametrize(("state", "keys", "mart", "plain"), KINDS)
def test_states_add_up(parts, state, keys, mart, plain):
    a, b, c = (state(p) for p in parts)
    whole = parts[0].unionAll(parts[1]).unionAll(parts[2])
    expected = rows(plain(whole))
    assert rows(mart(mart_state.merged(keys, [a, b, c]))) == expected
    assert rows(mart(mart_state.merged(keys, [mart_state.merged(keys, [c, a]), b]))) == expected
    assert rows(mart(state(whole))) == expected


@pytest.mark.parametrize(("state", "keys", "mart", "plain"), KINDS)
def test_a_part_is_taken_back(parts, state, keys, mart, plain):
    a, b, c = (state(p) for p in parts)
    both = mart_state.merged(keys, [a, b, c])
    back = mart_state.merged(keys, [both], [b, c])
    assert rows(mart(back)) == rows(plain(parts[0]))
    assert rows(back) == rows(mart_state.merged(keys, [a]))
    assert mart_state.merged(keys, [both], [both]).isEmpty()
