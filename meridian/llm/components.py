"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.llm.common import checkpointed


def _mins(pairs: DataFrame) -> DataFrame:
    """pairs(a, b): each a with the least of itself and its neighbours. Partial sums keep a hub out of one task."""
    return pairs.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))


def components(links: DataFrame, max_rounds: int = 50) -> DataFrame:
    """links(a long, b long), any order, repeats allowed -> (a, label): the least node of a's component.

    Nodes without links don't appear. Nulls and self-links are left out. Every round is checkpointed; a round costs
    two aggregations and two joins, whose hub keys adaptive execution splits. Raises if it hasn't settled in
    ``max_rounds`` (the number of rounds grows with the logarithm of the longest chain).
    """
    edges = checkpointed(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_mins(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = _mins(large)
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = checkpointed(small.unionByName(least.select("a", F.col("m").alias("b")).where("a <> b")).distinct())
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if before is not None and (now.n, now.h) == before:
            return edges.select("a", F.col("b").alias("label"))
        before = (now.n, now.h)
    raise RuntimeError(f"components have not settled in {max_rounds} rounds")
