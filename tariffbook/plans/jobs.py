"""From raw tables to the enriched fact and the two marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tariffbook.functions.dates import AsOf
from tariffbook.functions.text import trim_strings
from tariffbook.operators.enrichment import enrich
from tariffbook.operators.marts import monthly_revenue, subscriber_summary
from tariffbook.operators.plans import price_history
from tariffbook.operators.pricing import resolve_prices
from tariffbook.operators.profiling import observed
from tariffbook.operators.rejects import rejects
from tariffbook.operators.subscribers import clean_subscribers
from tariffbook.operators.subscriptions import (
    normalise_billing_country,
    not_cancelled,
    type_subscriptions,
)
from tariffbook.schemas import ENRICHED_SUBSCRIPTIONS, RAW_FILES
from tariffbook.sources import releases
from tariffbook.sources.files import export_csv, write_table
from tariffbook.streaming import intake

RawTables = tuple[DataFrame, DataFrame, DataFrame]


def priced_subscriptions(raw_subscriptions: DataFrame, history: DataFrame, strategy: str = "bucketed") -> DataFrame:
    """Typed, not cancelled, on a known plan, priced. Subscribers are not looked at yet."""
    kept = normalise_billing_country(type_subscriptions(not_cancelled(raw_subscriptions)))
    return resolve_prices(kept, history, known_plans_only=True, strategy=strategy)


def build_enriched(
    raw_subscriptions: DataFrame,
    subscribers: DataFrame,
    history: DataFrame,
    as_of: AsOf = None,
    strategy: str = "bucketed",
) -> DataFrame:
    """Same rows as cleaning, pricing and enriching one after the other, with fewer shuffles of the fact.

    The lookup of the current price also drops unknown plans, and the join to
    the subscriber attributes also drops unknown subscribers, so neither needs
    a semi join before it. Counting before that last join is safe: it keeps or
    drops a subscriber's rows all together.
    """
    return enrich(priced_subscriptions(raw_subscriptions, history, strategy), subscribers, as_of)


def build_marts(enriched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Subscriber summary and monthly revenue, on trimmed text."""
    trimmed = trim_strings(enriched)
    return subscriber_summary(trimmed), monthly_revenue(trimmed)


class Stage:
    """Writes tables below one folder that all executors share, and keeps a row count of each."""

    def __init__(self, spark: SparkSession, output_dir: str) -> None:
        self.spark, self.output_dir = spark, output_dir
        self.rows: dict[str, Observation] = {}

    def table(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        """Write a table and read it back, which cuts the lineage: a lost executor costs this stage at most."""
        counted, self.rows[name] = observed(df, name)
        write_table(counted, self._path(name), partition_by)
        return self.read(name, df.schema)

    def read(self, name: str, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self._path(name))

    def report(self, name: str, df: DataFrame) -> None:
        counted, self.rows[name] = observed(df, name)
        export_csv(counted, f"{self.output_dir}/analytics/{name}")

    def _path(self, name: str) -> str:
        return f"{self.output_dir}/staged/{name}"


TABLES = {name.removesuffix(".csv"): schema for name, schema in RAW_FILES.items()}


def ingest(spark: SparkSession, source_dir: str, landing_dir: str) -> None:
    """Take the waiting deliveries into the landing zone, one after the other; known contents are not landed again.

    A delivery is a folder below ``source_dir`` (or that folder itself). Nothing
    is taken in unless each waiting delivery holds all three inputs.
    """
    intake.ingest(spark, source_dir, landing_dir, TABLES)


def landed(spark: SparkSession, landing_dir: str) -> RawTables:
    """The newest delivery of the three inputs."""
    subscribers, plans, subscriptions = (
        intake.current(spark, landing_dir, table, schema) for table, schema in TABLES.items()
    )
    return subscribers, plans, subscriptions


def bad_lines(spark: SparkSession, landing_dir: str) -> DataFrame:
    """Lines of the newest delivery that are no records, as rejects: ``table, record_id, rule, rows``.

    The id of a line is its file and number.
    """
    files = intake.current_files(spark, landing_dir)
    found = [
        intake.bad_lines(spark, landing_dir, table, files).select(
            F.lit(table).alias("table"), F.concat_ws(":", "path", "line").alias("record_id"),
            F.col("reason").alias("rule"), F.lit(1).cast("bigint").alias("rows"),
        )
        for table in TABLES
    ]
    return reduce(DataFrame.unionAll, found)


def transform(
    spark: SparkSession, raw: RawTables, output_dir: str, as_of: AsOf = None, more_rejects: DataFrame | None = None
) -> dict[str, Observation]:
    """Raw tables to staged tables and rejects, with ``more_rejects``. The counts per table were taken while writing.

    The priced fact is a stage of its own, since both the count per subscriber
    and the join to the subscribers need it.
    """
    raw_subscribers, raw_plans, raw_subscriptions = raw
    stage = Stage(spark, output_dir)
    subscribers = stage.table("clean_subscribers", clean_subscribers(raw_subscribers))
    history = stage.table("plan_price_history", price_history(raw_plans, as_of))
    priced = stage.table("priced_subscriptions", priced_subscriptions(raw_subscriptions, history))
    stage.table("enriched_subscriptions", enrich(priced, subscribers, as_of), ["subscription_month"])
    dropped = rejects(*raw, subscribers, history)
    stage.table("rejects", dropped if more_rejects is None else dropped.unionByName(more_rejects))
    return stage.rows


def analytics(spark: SparkSession, output_dir: str) -> dict[str, Observation]:
    """The two reports, from the staged fact."""
    stage = Stage(spark, output_dir)
    summary, revenue = build_marts(stage.read("enriched_subscriptions", ENRICHED_SUBSCRIPTIONS))
    stage.report("subscriber_summary", summary)
    stage.report("monthly_revenue", revenue)
    return stage.rows


def run(spark: SparkSession, source_dir: str, output_dir: str, as_of: AsOf = None) -> dict[str, Observation]:
    """All three steps. Landing zone, staged tables and reports all lie under ``output_dir``, each written over in place."""
    landing_dir = f"{output_dir}/landing"
    ingest(spark, source_dir, landing_dir)
    raw, bad = landed(spark, landing_dir), bad_lines(spark, landing_dir)
    return transform(spark, raw, output_dir, as_of, bad) | analytics(spark, output_dir)


def publish(spark: SparkSession, source_dir: str, output_dir: str, as_of: AsOf = None, keep: int = 2) -> dict[str, int]:
    """All three steps, in a folder of the run's own that becomes the current one only when all is written; rows per table.

    A run that fails leaves the one before as it was; the last ``keep`` stay.
    """
    landing_dir = f"{output_dir}/landing"
    ingest(spark, source_dir, landing_dir)
    number, folder = releases.new_run(spark, output_dir)
    raw, bad = landed(spark, landing_dir), bad_lines(spark, landing_dir)
    counted = transform(spark, raw, folder, as_of, bad) | analytics(spark, folder)
    rows = {name: observation.get["rows"] for name, observation in counted.items()}
    releases.publish(spark, output_dir, number, rows)
    releases.tidy(spark, output_dir, keep)
    return rows


def published(spark: SparkSession, output_dir: str, name: str, schema: StructType) -> DataFrame:
    """A staged table of the current run."""
    now = releases.published(spark, output_dir)
    if now is None:
        raise FileNotFoundError(f"nothing is published in {output_dir}")
    return Stage(spark, now[1]).read(name, schema)
