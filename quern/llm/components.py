"""Connected components of a table of links, by stars that shrink towards the least member."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.session import written


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for each node of `links` (a, b) but the roots; root: the least node of its component.

    Each round ties a node's larger neighbours to its least one, then its smaller ones, so paths halve; rounds grow with
    the logarithm of the longest path. Each round is written to the shared folder. Links may repeat."""
    pairs = links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs, before = written(pairs, "links"), None
    for _ in range(max_rounds):
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written, so that the join can split a hub's links over tasks
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "large")
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
        pairs = written(small.select("x.*").filter("u != v").distinct(), "links")
        state = tuple(pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())
        if state == before:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
    raise RuntimeError(f"components didn't settle in {max_rounds} rounds")
