"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultspark.llm.common import written


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)``; root is the smallest node reachable.

    Each step is a minimum per node (partially aggregated before the shuffle) joined back to the edges, so a
    hub with very many links is split by the skew join and never gathered.  Every round is a written table.
    Self-links and repeated edges are allowed; an empty input gives an empty result.
    """
    def ordered(df: DataFrame) -> DataFrame:
        return (df.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())

    def star(df: DataFrame, both_ways: bool) -> DataFrame:
        links = df.union(df.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both_ways else df
        low = links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        joined = links.join(low, "u")
        if both_ways:  # large star: link every larger neighbour to the minimum
            return ordered(joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        return ordered(joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", "m")))

    def signature(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % 1000003)).first()

    links = written(ordered(edges.select("u", "v")), "edges")
    last = signature(links)
    for _ in range(max_rounds):
        links = written(star(star(links, True), False), "edges")
        now = signature(links)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = links.select("v").distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root")))
