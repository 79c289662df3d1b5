"""Date rules. Parsing never throws: under ANSI mode an unreadable value is null."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two input formats, told apart by their separator, and the end of an open interval.
SLASH_FORMAT, ISO_FORMAT = "M/d/yyyy", "yyyy-MM-dd"
OPEN_END = date(9999, 12, 31)
# Fixed value: a subscription is long-term beyond this many days.
LONG_TERM_DAYS = 183

AsOf = date | Column | None


def run_date(as_of: AsOf) -> Column:
    """The date that open subscriptions and versions are measured against; today if none is given."""
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def parse_date(c: Column) -> Column:
    """Date in either input format; null if it is in neither.

    A text with a slash can only be in the first format and any other only in
    the second, so each is parsed once: a failed attempt costs far more.
    """
    return F.when(c.contains("/"), F.try_to_date(c, SLASH_FORMAT)).otherwise(F.try_to_date(c, ISO_FORMAT))


def parse_iso_date(c: Column) -> Column:
    """Spark's default date text (``yyyy-MM-dd``, also with a time part)."""
    return c.try_cast("date")


def end_or_open(c: Column) -> Column:
    """Missing end means an open interval; an unreadable end stays null and so never matches."""
    return F.when(c.isNull(), F.lit(OPEN_END)).otherwise(parse_date(c))


def active_flag(end: Column, as_of: AsOf) -> Column:
    return F.when(end >= run_date(as_of), "Y").otherwise("N")


def duration_days(start: Column, end: Column, as_of: AsOf) -> Column:
    """Days from start to end, or to the run date while open. Negative if the end precedes the start."""
    return F.datediff(F.coalesce(end, run_date(as_of)), start)


def is_long_term(days: Column) -> Column:
    return days > LONG_TERM_DAYS


def month_key(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")
