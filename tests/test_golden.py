"""The whole chain on the fixed rows, from CSV files to CSV reports."""

import csv
import io

import golden
import pytest

from tariffbook.operators import rejects as reject_rules
from tariffbook.operators.enrichment import enrich
from tariffbook.operators.marts import monthly_revenue, subscriber_summary
from tariffbook.operators.plans import price_history
from tariffbook.operators.pricing import resolve_prices
from tariffbook.operators.subscribers import clean_subscribers
from tariffbook.operators.subscriptions import clean_subscriptions
from tariffbook.plans import jobs
from tariffbook.schemas import ENRICHED_SUBSCRIPTIONS
from tariffbook.sources.files import export_csv, read_csv, read_raw
from tariffbook.streaming.intake import read_ledger


def records(text):
    return list(csv.DictReader(io.StringIO(text)))


def as_text(value):
    if value is None:
        return ""
    if isinstance(value, bool):
        return str(value).lower()
    return str(value)


def same(df, expected):
    """Rows of ``expected`` (CSV text) as a set of named values; numbers compare as numbers."""
    names = list(records(expected)[0])

    def number(text):
        try:
            return float(text)
        except ValueError:
            return text

    ours = sorted(tuple(number(as_text(v)) for v in row) for row in df.select(*names).collect())
    theirs = sorted(tuple(number(r[n]) for n in names) for r in records(expected))
    assert ours == theirs


@pytest.fixture(scope="module")
def source_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("golden")
    for name in ("subscribers", "plans", "subscriptions"):
        (folder / f"{name}.csv").write_text(getattr(golden, name.upper()))
    return str(folder)


@pytest.fixture(scope="module")
def tables(spark, source_dir):
    raw_subscribers, raw_plans, raw_subscriptions = read_raw(spark, source_dir)
    subscribers, history = clean_subscribers(raw_subscribers), price_history(raw_plans, golden.AS_OF)
    return raw_subscribers, raw_plans, raw_subscriptions, subscribers, history


def test_clean_subscribers(tables):
    same(tables[3], golden.CLEAN_SUBSCRIBERS)


def test_plan_price_history(tables):
    same(tables[4], golden.PLAN_PRICE_HISTORY)


@pytest.mark.parametrize("strategy", ["bucketed", "plain"])
def test_enriched_short_way(tables, strategy):
    _, _, raw, subscribers, history = tables
    enriched = jobs.build_enriched(raw, subscribers, history, golden.AS_OF, strategy)
    same(enriched, golden.ENRICHED_SUBSCRIPTIONS)


def test_enriched_step_by_step(tables):
    _, _, raw, subscribers, history = tables
    priced = resolve_prices(clean_subscriptions(raw, subscribers, history), history)
    enriched = enrich(priced, subscribers, golden.AS_OF)
    same(enriched, golden.ENRICHED_SUBSCRIPTIONS)
    assert enriched.columns == ENRICHED_SUBSCRIPTIONS.names
    ours = {f.name: f.dataType for f in enriched.schema.fields}
    assert ours == {f.name: f.dataType for f in ENRICHED_SUBSCRIPTIONS.fields}


def test_marts(tables):
    _, _, raw, subscribers, history = tables
    enriched = jobs.build_enriched(raw, subscribers, history, golden.AS_OF)
    same(subscriber_summary(enriched), golden.SUBSCRIBER_SUMMARY)
    same(monthly_revenue(enriched), golden.MONTHLY_REVENUE)


def test_rejects(tables):
    rows = reject_rules.rejects(*tables).collect()
    ids = {}
    for row in rows:
        ids.setdefault(row["rule"], []).extend([row["record_id"]] * row["rows"])
    assert {rule: sorted(i or "" for i in found) for rule, found in ids.items()} == {
        "invalid_email": ["SUB003", "SUB006", "SUB017", "SUB026"],
        "duplicate_email": ["SUB001"],
        "blank_plan_id": [""],
        "null_or_negative_price": ["PLAN004", "PLAN005"],
        "orphan_subscriber": ["SUBS0001", "SUBS0026", "SUBS0028"],
        "orphan_plan": ["SUBS0029"],
        "cancelled": ["SUBS0011", "SUBS0019", "SUBS0030"],
    }


STAGED_ROWS = {
    "clean_subscribers": 25,
    "plan_price_history": 19,
    "priced_subscriptions": 31,
    "enriched_subscriptions": 28,
    "rejects": 15,
}
REPORT_ROWS = {"subscriber_summary": 10, "monthly_revenue": 23}


def rows_of(counts):
    return {name: observation.get["rows"] for name, observation in counts.items()}


def reports_are_golden(folder):
    for mart in REPORT_ROWS:
        parts = sorted((folder / "analytics" / mart).glob("part-*.csv"))
        header = parts[0].read_text().splitlines()[0]
        lines = [line for part in parts for line in part.read_text().splitlines()[1:]]
        assert [header, *lines] == getattr(golden, mart.upper()).strip().splitlines()


def deliver(folder, **changed):
    folder.mkdir(parents=True)
    for name in ("subscribers", "plans", "subscriptions"):
        (folder / f"{name}.csv").write_text(changed.get(name, getattr(golden, name.upper())))


def test_whole_run(spark, tmp_path):
    source, out = tmp_path / "source", tmp_path / "out"
    deliver(source / "2026-05-30")
    assert rows_of(jobs.run(spark, str(source), str(out), golden.AS_OF)) == STAGED_ROWS | REPORT_ROWS
    staged = spark.read.schema(ENRICHED_SUBSCRIPTIONS).parquet(f"{out}/staged/enriched_subscriptions")
    same(staged, golden.ENRICHED_SUBSCRIPTIONS)
    reports_are_golden(out)

    # The same contents delivered again are not taken in again, and change nothing.
    deliver(source / "2026-05-31")
    assert rows_of(jobs.run(spark, str(source), str(out), golden.AS_OF)) == STAGED_ROWS | REPORT_ROWS
    reports_are_golden(out)
    ledger = read_ledger(spark, f"{out}/landing").filter("table = 'plans'").orderBy("path").collect()
    assert [(e.state, e.rows) for e in ledger] == [("landed", 22), ("known", 22)]

    # A new delivery of one table replaces the last one.
    fewer = "\n".join(golden.SUBSCRIPTIONS.splitlines()[:11])
    deliver(source / "2026-06-01", subscriptions=fewer)
    counts = rows_of(jobs.run(spark, str(source), str(out), golden.AS_OF))
    assert counts["enriched_subscriptions"] == 9


def test_transform_without_landing_zone(spark, source_dir, tmp_path):
    assert rows_of(jobs.transform(spark, read_raw(spark, source_dir), str(tmp_path), golden.AS_OF)) == STAGED_ROWS
    assert rows_of(jobs.analytics(spark, str(tmp_path))) == REPORT_ROWS
    reports_are_golden(tmp_path)


def test_marts_from_a_staged_csv(spark, tables, tmp_path):
    """Round trip of the fact through CSV, read back with the fixed schema."""
    _, _, raw, subscribers, history = tables
    enriched = jobs.build_enriched(raw, subscribers, history, golden.AS_OF)
    export_csv(enriched, str(tmp_path / "enriched"))
    staged = read_csv(spark, str(tmp_path / "enriched"), ENRICHED_SUBSCRIPTIONS)
    assert staged.schema == ENRICHED_SUBSCRIPTIONS
    summary, revenue = jobs.build_marts(staged)
    same(summary, golden.SUBSCRIBER_SUMMARY)
    same(revenue, golden.MONTHLY_REVENUE)


def test_run_names_missing_inputs(spark, tmp_path):
    (tmp_path / "plans.csv").write_text(golden.PLANS)
    with pytest.raises(FileNotFoundError, match="subscribers.csv, subscriptions.csv"):
        jobs.run(spark, str(tmp_path), str(tmp_path / "out"), golden.AS_OF)
    assert not (tmp_path / "out").exists()
