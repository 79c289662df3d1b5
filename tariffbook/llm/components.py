"""Connected components of a graph that is too large for one machine.

Alternates the two star operations (each node links its larger neighbours, then
itself and its smaller ones, to its smallest neighbour) until nothing changes.
The least neighbour is an aggregate and comes back by a join that can be split,
so a node with very many links is no single task's work. Each round is written
to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tariffbook.llm.common import staged
from tariffbook.operators.skew import lookup_join


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node, root``: the smallest node reachable, for each node that has a link to another one."""
    edges = (
        links.where(F.col(left) != F.col(right))
        .select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b"))
        .distinct()
    )
    edges, state = staged(edges, "links"), None
    while True:
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = lookup_join(both, least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = staged(large.where("a <> b").distinct(), "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = lookup_join(large, least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = staged(small.unionAll(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
