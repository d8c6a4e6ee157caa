"""Connected components by alternating large-star and small-star steps, each cut to a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import cut


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(pairs: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, root) for every id in ``pairs`` (a, b); root is the smallest id of the component.

    Nothing is collected: a round is one aggregation to the least neighbour and one
    join back. Nodes of high degree are pre-aggregated. An empty input gives an empty result.
    """
    edges = cut(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges")
    before = _state(edges)
    for _ in range(most_rounds):
        # Large star: the larger neighbours of a node are tied to the least of its neighbourhood.
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a < b").distinct()
        # Small star: a node and its smaller neighbours are tied to the least of them.
        small = large.groupBy("b").agg(F.min("a").alias("m"))
        tied = large.join(small, "b").select(F.col("m").alias("lo"), F.explode(F.array("a", "b")).alias("hi"))
        edges = cut(tied.where("lo < hi").select(F.col("lo").alias("a"), F.col("hi").alias("b")).distinct(), "edges")
        after = _state(edges)
        if after == before:
            roots = edges.select(F.col("b").alias("id"), F.col("a").alias("root"))
            return roots.unionByName(edges.select(F.col("a").alias("id"), F.col("a").alias("root")).distinct())
        before = after
    raise RuntimeError(f"no stable components after {most_rounds} rounds")
