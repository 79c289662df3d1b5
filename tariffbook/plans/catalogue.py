"""Named queries over the star schema tables, each checked against ``oracle.py``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tariffbook.functions import dates, text
from tariffbook.operators import (
    coverage,
    enrichment,
    mart_state,
    marts,
    plans,
    pricing,
    profiling,
    rejects,
    subscribers,
    subscriptions,
)
from tariffbook.plans import jobs
from tariffbook.schemas import RAW_SUBSCRIBERS
from tariffbook.sources import lines, manifest, warehouse
from tariffbook.streaming import intake

INPUT_TABLES = ["customer", "nation", "part", "orders", "lineitem", "documents"]
# Languages in which every source of documents is expected to deliver a file.
LANGUAGES = ["de", "en", "es", "fr", "it"]


@dataclass
class Tables:
    """Lazily built inputs and intermediate tables of the queries."""

    spark: SparkSession
    sf_dir: str

    def source(self, name: str) -> DataFrame:
        return warehouse.table(self.spark, self.sf_dir, name)

    @cached_property
    def raw_subscribers(self) -> DataFrame:
        return warehouse.raw_subscribers(self.spark, self.sf_dir)

    @cached_property
    def raw_plans(self) -> DataFrame:
        return warehouse.raw_plans(self.spark, self.sf_dir)

    @cached_property
    def raw_subscriptions(self) -> DataFrame:
        return warehouse.raw_subscriptions(self.spark, self.sf_dir)

    @cached_property
    def subscribers(self) -> DataFrame:
        return subscribers.clean_subscribers(self.raw_subscribers)

    @cached_property
    def history(self) -> DataFrame:
        return plans.price_history(self.raw_plans, warehouse.AS_OF)

    @cached_property
    def typed(self) -> DataFrame:
        return subscriptions.type_subscriptions(self.raw_subscriptions)

    @cached_property
    def fact(self) -> DataFrame:
        return subscriptions.clean_subscriptions(self.raw_subscriptions, self.subscribers, self.history)

    def priced(self, strategy: str = "bucketed") -> DataFrame:
        """The priced fact; the lookup of the current price drops unknown plans, so they need no semi join."""
        known = subscriptions.with_known_subscriber(self.raw_subscriptions, self.subscribers)
        return jobs.priced_subscriptions(known, self.history, strategy)

    @cached_property
    def enriched(self) -> DataFrame:
        return jobs.build_enriched(self.raw_subscriptions, self.subscribers, self.history, warehouse.AS_OF)


def _plain(df: DataFrame) -> DataFrame:
    """Amounts and ratings as doubles."""
    return df.select(
        *(
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
            for f in df.schema.fields
        )
    )


def _cents(name: str) -> Column:
    return (F.col(name) * 100).cast("long")


def normalise_country(t: Tables) -> DataFrame:
    return t.raw_subscribers.select(
        "subscriber_id", F.col("country").alias("country_raw"), text.normalise_country(F.col("country")).alias("country")
    )


def normalise_phone(t: Tables) -> DataFrame:
    return t.raw_subscribers.select("subscriber_id", text.normalise_phone(F.col("phone")).alias("phone"))


def phone_from_documents(t: Tables) -> DataFrame:
    tokens = t.source("documents").select("doc_id", F.explode(text.phone_tokens(F.col("text"))).alias("token"))
    return tokens.withColumn("phone", text.normalise_phone(F.col("token")))


def valid_email_filter(t: Tables) -> DataFrame:
    return subscribers.with_valid_email(t.raw_subscribers).select("subscriber_id", "email")


def email_from_documents(t: Tables) -> DataFrame:
    with_at = t.source("documents").filter(F.col("text").contains("@"))
    tokens = with_at.select("doc_id", F.explode(text.words_with_at(F.col("text"))).alias("token"))
    return tokens.withColumn("is_valid", text.is_valid_email(F.col("token")))


def fill_missing_name(t: Tables) -> DataFrame:
    return t.raw_subscribers.select("subscriber_id", text.fill_name(F.col("name")).alias("name"))


def trim_all_strings(t: Tables) -> DataFrame:
    return text.trim_strings(t.raw_subscribers)


def parse_dates_multi(t: Tables) -> DataFrame:
    raw = t.raw_plans.select("plan_id", F.explode(F.array("effective_date", "end_date")).alias("raw"))
    return raw.withColumn("parsed", dates.parse_date(F.col("raw")))


def plan_rows_valid(t: Tables) -> DataFrame:
    return plans.valid_plan_rows(t.raw_plans).select(
        "plan_id", "plan_tier", _cents("price_per_month").alias("price_cents"), "effective_date", "end_date"
    )


def plan_price_history(t: Tables) -> DataFrame:
    return t.history.select(
        "plan_id", "plan_tier", _cents("price_per_month").alias("price_cents"), "effective_date", "end_date", "is_active"
    )


def current_prices(t: Tables) -> DataFrame:
    prices = plans.current_prices(t.history)
    return prices.select("plan_id", _cents("current_price").alias("current_price_cents"))


def dedup_earliest_signup(t: Tables) -> DataFrame:
    kept = subscribers.earliest_per_email(subscribers.with_valid_email(t.raw_subscribers))
    return kept.select("email", "subscriber_id", "signup_date")


def clean_subscribers(t: Tables) -> DataFrame:
    return t.subscribers


def fill_monthly_charge(t: Tables) -> DataFrame:
    filled = subscriptions.fill_monthly_charge(t.raw_subscriptions)
    return filled.select("subscription_id", F.col("monthly_charge").cast("double").alias("charge"))


def orphan_subscribers(t: Tables) -> DataFrame:
    return subscriptions.orphan_subscribers(t.raw_subscriptions, t.subscribers).select("subscription_id")


def orphan_plans(t: Tables) -> DataFrame:
    return subscriptions.orphan_plans(t.raw_subscriptions, t.history).select("subscription_id")


def valid_subscriber_semi(t: Tables) -> DataFrame:
    return subscriptions.with_known_subscriber(t.raw_subscriptions, t.subscribers).select("subscription_id")


def valid_plan_semi(t: Tables) -> DataFrame:
    return subscriptions.with_known_plan(t.raw_subscriptions, t.history).select("subscription_id")


def distinct_plan_keys(t: Tables) -> DataFrame:
    return plans.plan_keys(t.history)


def active_status_filter(t: Tables) -> DataFrame:
    return subscriptions.not_cancelled(t.raw_subscriptions).select("subscription_id", "status")


def clean_subscriptions(t: Tables) -> DataFrame:
    return _plain(t.fact)


def rejects_by_rule(t: Tables) -> DataFrame:
    return rejects.rejects_by_rule(t.raw_subscribers, t.raw_plans, t.raw_subscriptions, t.subscribers, t.history)


def rejected_records(t: Tables) -> DataFrame:
    return rejects.rejects(t.raw_subscribers, t.raw_plans, t.raw_subscriptions, t.subscribers, t.history)


def _resolved(priced: DataFrame) -> DataFrame:
    return priced.select(
        "subscription_id",
        "plan_id",
        "subscription_start_date",
        "plan_tier",
        F.col("actual_monthly_price").cast("double").alias("actual_monthly_price"),
    )


def scd_price_resolution(t: Tables) -> DataFrame:
    return _resolved(t.priced("plain"))


def scd_price_resolution_bucketed(t: Tables) -> DataFrame:
    return _resolved(t.priced("bucketed"))


def price_gaps_and_overlaps(t: Tables) -> DataFrame:
    return coverage.gaps_and_overlaps(t.history)


def scd_price_as_of(t: Tables) -> DataFrame:
    """Prices by the last version before each day, for the plans whose versions do not overlap."""
    history = coverage.without_overlaps(t.history)
    known = subscriptions.with_known_subscriber(t.raw_subscriptions, t.subscribers)
    return _resolved(jobs.priced_subscriptions(known, history, "as_of"))


def unresolved_prices(t: Tables) -> DataFrame:
    return pricing.unresolved(t.priced()).groupBy("plan_id").agg(F.count(F.lit(1)).alias("rows"))


def price_variance(t: Tables) -> DataFrame:
    return _plain(
        enrichment.with_price_variance(t.priced()).select(
            "subscription_id", "actual_monthly_price", "current_price", "price_variance"
        )
    )


def total_subscriptions(t: Tables) -> DataFrame:
    return t.enriched.select("subscription_id", "subscriber_id", "total_subscriptions")


def subscription_duration(t: Tables) -> DataFrame:
    parsed = subscriptions.parse_subscription_dates(t.raw_subscriptions)
    return enrichment.with_duration(parsed, warehouse.AS_OF).select(
        "subscription_id", "duration_days", "long_term_subscriber"
    )


def subscription_month(t: Tables) -> DataFrame:
    parsed = subscriptions.parse_subscription_dates(t.raw_subscriptions)
    return enrichment.with_month(parsed).select("subscription_id", "subscription_month")


def enriched_subscriptions(t: Tables) -> DataFrame:
    return _plain(t.enriched)


def subscriber_summary(t: Tables) -> DataFrame:
    return marts.subscriber_summary(text.trim_strings(t.enriched))


def monthly_revenue(t: Tables) -> DataFrame:
    return marts.monthly_revenue(text.trim_strings(t.enriched))


def monthly_revenue_merged(t: Tables) -> DataFrame:
    """The mart from states of two parts of the fact, one of them added twice and taken back once."""
    fact, keys = text.trim_strings(t.enriched), mart_state.REVENUE_KEYS
    odd = F.pmod(F.xxhash64("subscription_id"), F.lit(2)) == 1
    one, two = mart_state.revenue_state(fact.where(odd)), mart_state.revenue_state(fact.where(~odd))
    return mart_state.monthly_revenue(mart_state.merged(keys, [one, two, two], [two]))


def monthly_revenue_preview(t: Tables) -> DataFrame:
    return marts.preview(monthly_revenue(t))


def monthly_revenue_top_n(t: Tables) -> DataFrame:
    return marts.top_months(monthly_revenue(t))


def stage_row_counts(t: Tables) -> DataFrame:
    return profiling.row_counts(
        {
            "raw_subscribers": t.raw_subscribers,
            "raw_plans": t.raw_plans,
            "raw_subscriptions": t.raw_subscriptions,
            "clean_subscribers": t.subscribers,
            "plan_price_history": t.history,
            "enriched_subscriptions": t.enriched,
        }
    )


def content_hash_dedup(t: Tables) -> DataFrame:
    return profiling.distinct_content(t.source("documents"), content="text", key="doc_id")


def input_file_rows(t: Tables) -> DataFrame:
    """Rows per input file, counted while scanning."""
    files = [t.source(name).select(F.col("_metadata.file_name").alias("file_name")) for name in INPUT_TABLES]
    return reduce(DataFrame.union, files).groupBy("file_name").agg(F.count(F.lit(1)).alias("rows"))


def input_manifest_missing(t: Tables) -> DataFrame:
    """Files that a source of documents should deliver, one per language, and does not."""
    parts = t.source("documents").select("source", "lang").distinct()
    names = F.explode(F.array(*(F.concat("source", F.lit(f"-{lang}")) for lang in LANGUAGES)))
    present = parts.select(F.concat_ws("-", "source", "lang").alias("file_name"))
    return manifest.missing_inputs(parts.select("source").distinct().select(names.alias("file_name")), present)


def delivery_ledger(t: Tables) -> DataFrame:
    """Ledger of two deliveries of the documents, a file per source.

    The second delivery holds each file twice, and the last document of every
    source whose highest id is even has been edited since the first.
    """
    docs = t.source("documents").select("doc_id", "text", "lang", "source")
    first = docs.select(F.concat(F.lit("a/"), "source").alias("path"), "doc_id", "text", "lang")
    last = docs.groupBy("source").agg(F.max("doc_id").alias("last")).filter("last % 2 = 0").select("last")
    edited = docs.join(last, docs["doc_id"] == last["last"], "left")
    text_now = F.when(F.col("last").isNotNull(), F.concat("text", F.lit("."))).otherwise(F.col("text"))
    second = edited.select(
        F.explode(F.array(*(F.concat(F.lit("b/"), "source", F.lit(f"-{n}")) for n in (1, 2)))).alias("path"),
        "doc_id", text_now.alias("text"), "lang",
    )
    digests = intake.file_digests(first)
    entries = intake.ledger_entries(digests, digests.limit(0))
    later = intake.ledger_entries(intake.file_digests(second), entries.filter("state = 'landed'"))
    numbered = [df.select("path", F.lit(n).alias("number"), "rows", "state") for n, df in ((1, entries), (2, later))]
    return numbered[0].union(numbered[1])


def content_digests(t: Tables) -> DataFrame:
    """Digests of files of a thousand documents, a line each, put together from parts of a hundred."""
    docs = t.source("documents").selectExpr("doc_id div 1000 AS file", "doc_id % 1000 AS k", "text AS value")
    read = docs.selectExpr("concat('file-', file) AS path", "k div 100 * 100 AS block", "k + 7 AS seq", "value")
    lengths = read.groupBy("path").agg(F.sum(F.octet_length("value") + 1).alias("length"))
    return lines.file_contents(read, lengths).select("path", "content_md5", "lines")


def records_and_bad_lines(t: Tables) -> DataFrame:
    """Subscribers as lines of text, some of them broken, told apart and read again."""
    key, fields = F.col("subscriber_id"), RAW_SUBSCRIBERS.names
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields]
    texts[1] = F.concat(F.lit('"'), texts[1], F.lit(', \\"q\\","'))
    header = ",".join([*fields, "note"])
    value = (
        F.when(key % 13 == 1, F.concat_ws(",", *texts))
        .when(key % 17 == 2, F.concat_ws(",", *texts, F.lit("x,y"), F.lit("z")))
        .when(key % 19 == 3, F.concat_ws(",", *texts[:4], F.lit('"open'), *texts[5:], F.lit("x")))
        .when(key % 23 == 4, "  ")
        .when(key % 29 == 5, header)
        .otherwise(F.concat_ws(",", *texts, F.lit('"a, b"')))
    )
    told = lines.records(t.raw_subscribers.select(key.alias("line"), value.alias("value")), header, RAW_SUBSCRIBERS)
    return told.select("line", "kind", "raw", "subscriber_id", "name", "email", "country", "signup_date", "age")


QUERIES: list[Callable[[Tables], DataFrame]] = [
    normalise_country,
    normalise_phone,
    phone_from_documents,
    valid_email_filter,
    email_from_documents,
    fill_missing_name,
    trim_all_strings,
    parse_dates_multi,
    plan_rows_valid,
    plan_price_history,
    current_prices,
    dedup_earliest_signup,
    clean_subscribers,
    fill_monthly_charge,
    orphan_subscribers,
    orphan_plans,
    valid_subscriber_semi,
    valid_plan_semi,
    distinct_plan_keys,
    active_status_filter,
    clean_subscriptions,
    rejects_by_rule,
    rejected_records,
    scd_price_resolution,
    scd_price_resolution_bucketed,
    scd_price_as_of,
    price_gaps_and_overlaps,
    unresolved_prices,
    price_variance,
    total_subscriptions,
    subscription_duration,
    subscription_month,
    enriched_subscriptions,
    subscriber_summary,
    monthly_revenue,
    monthly_revenue_merged,
    monthly_revenue_top_n,
    monthly_revenue_preview,
    stage_row_counts,
    content_hash_dedup,
    input_manifest_missing,
    delivery_ledger,
    content_digests,
    records_and_bad_lines,
    input_file_rows,
]


def _bound(query: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(Tables(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: _bound(query) for query in QUERIES}
