"""Connected components by alternating large and small stars, each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import stored


def _with_least(edges: DataFrame, own: bool) -> DataFrame:
    """Each edge with the smallest neighbour ``m`` of its node ``a``; ``own`` counts ``a`` too."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    if own:
        least = least.withColumn("m", F.least("a", "m"))
    return edges.join(least, "a")


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)`` that isn't its component's root.

    The root is the smallest node. A node of many edges costs one row per edge: its minimum
    is summed up before the shuffle and Spark splits the join where a node is skewed. Loops
    and repeated edges don't matter; no edges give no rows. Nodes are not null.
    """
    a, b = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    stars = stored(edges.select(a, b).where("a <> b").distinct(), "edges")

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    seen = mark(stars)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_least(both, own=True).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        small = _with_least(large, own=False)
        pairs = F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("p")
        small = small.select(pairs).select(F.col("p.b").alias("a"), F.col("p.m").alias("b")).where("a <> b")
        stars = stored(small.distinct(), "stars")
        now = mark(stars)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components still change after {max_rounds} rounds")
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
