"""Row counts and content hashes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``table, rows`` for several tables in one result."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.union, counts)


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """The same rows, with a row count (and further aggregates) taken while they are written."""
    observation = Observation(name)
    extra = [column.alias(alias) for alias, column in metrics.items()]
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *extra), observation


def row_md5(df: DataFrame) -> Column:
    """md5 of a row's values. Nulls and empty texts differ, and no value can run into the next."""
    values = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in df.columns]
    lengths = [F.length(v).cast("string") for v in values]
    return F.md5(F.concat_ws("|", *lengths, *values).cast("binary"))


def distinct_content(df: DataFrame, content: str, key: str) -> DataFrame:
    """``content_md5, <key>, copies``: the lowest key of each distinct content and how often it occurs."""
    return (
        df.groupBy(F.md5(F.col(content).cast("binary")).alias("content_md5"))
        .agg(F.min(key).alias(key), F.count(F.lit(1)).alias("copies"))
    )
