"""Equi joins in which one key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shuffled(right: DataFrame) -> DataFrame:
    """``right``, not broadcast by the next join.

    Spark estimates what an explode or an aggregate makes by the bytes of the
    files behind it. A few MB of compressed rows may so be taken for a small
    table while they are millions of versions or plans, all to be collected by
    the driver. Joins to a price history or a table of its plans shuffle.
    """
    return right.hint("merge")


def lookup_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join ``left`` to a ``right`` that is already grouped by ``key``; columns as in ``left.join(right, key, how)``.

    Adaptive execution splits a skewed shuffle partition of ``left`` over
    several tasks, copies of one row included, but only where both sides are
    shuffled for that join alone. A grouped ``right`` would be joined where it
    stands. Matching the hash of the key as well changes no result and gives
    the join its own shuffle. With a broadcast ``right`` nothing is shuffled.
    """
    a, b = left.alias("_left"), right.alias("_right")
    left_key, right_key = F.col(f"_left.{key}"), F.col(f"_right.{key}")
    same_key = (left_key == right_key) & (F.xxhash64(left_key) == F.xxhash64(right_key))
    joined = a.join(b, same_key, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.select("_left.*", *(F.col(f"_right.{c}") for c in right.columns if c != key))
