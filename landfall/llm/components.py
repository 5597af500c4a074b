"""Connected components of a graph too large for the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import discard, stored


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the edges (a, b); a component is its least node.

    Alternates the two steps of Kiveris et al. (2014): each node hands its least neighbour
    to its larger neighbours, then to its smaller ones. No step collects a node's
    neighbours; least values are pre-aggregated, and each round is written to the shared
    folder. The rounds end when the edges no longer change, after about log^2 n of them.
    """
    current = stored(edges.where("a <> b").select("a", "b").distinct(), "edges")

    def state(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()

    before = state(current)
    for _ in range(rounds):
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        # Written, so that both sides of the join are shuffled and a hub's rows can be split.
        of_large = stored(least.select(F.col("a").alias("of"), F.least("a", "m").alias("m")), "least")
        large = (
            both.where("b > a").join(of_large, F.col("a") == F.col("of"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        )
        large = stored(large, "large_star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        of_small = stored(least.select(F.col("a").alias("of"), "m"), "least")
        small = large.join(of_small, F.col("a") == F.col("of")).select(
            F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        )
        following = stored(small.select("e.a", "e.b").where("a <> b").distinct(), "edges")
        discard(current, large, of_large, of_small)
        current = following
        after = state(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
