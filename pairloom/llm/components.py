"""Connected components of links between ids, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairloom.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``id, root``: the smallest reachable id for every id of ``a, b`` rows but the roots themselves.

    Rounds of large and small stars halve the depth, so their number grows with its logarithm. The minimum of a
    node with very many links is taken by a partial aggregate, and its join is left to the skew handling.
    """
    edges = scratch.stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), f"{name}-0")
    state, step = None, 0
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        step += 1
        large = scratch.stage(large, f"{name}-{step}l")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        following = scratch.stage(small.filter("u > v").distinct(), f"{name}-{step}")
        now = following.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        scratch.drop(f"{name}-{step}l", f"{name}-{step - 1}")
        edges = following
        if state == now:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
        state = now
