"""Subscriber dimension: email check, one row per email, filled and normalised attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tariffbook.functions.dates import parse_iso_date
from tariffbook.functions.text import fill_name, is_valid_email, normalise_country, normalise_phone


def with_valid_email(raw: DataFrame) -> DataFrame:
    return raw.filter(is_valid_email(F.col("email")))


def earliest_per_email(subscribers: DataFrame) -> DataFrame:
    """One row per exact email: earliest signup, a missing signup before all others.

    Equal signups go to the lower subscriber id, then to the smaller remaining
    values, so the result does not depend on row order. The ``= 1`` filter lets
    Spark cut every email to one row per task before the shuffle, so an email
    with very many rows never meets in one task.
    """
    dated = subscribers.withColumn("signup_date", parse_iso_date(F.col("signup_date")))
    others = [c for c in dated.columns if c not in ("email", "signup_date", "subscriber_id")]
    order = [F.col(c).asc_nulls_first() for c in ("signup_date", "subscriber_id", *others)]
    first = F.row_number().over(Window.partitionBy("email").orderBy(*order))
    return dated.withColumn("_nth", first).filter("_nth = 1").drop("_nth")


def clean_subscribers(raw: DataFrame) -> DataFrame:
    kept = earliest_per_email(with_valid_email(raw))
    return kept.select(
        "subscriber_id",
        fill_name(F.col("name")).alias("name"),
        "email",
        normalise_phone(F.col("phone")).alias("phone"),
        normalise_country(F.col("country")).alias("country"),
        "signup_date",
        F.col("age").try_cast("int").alias("age"),
    )
