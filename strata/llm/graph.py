"""Connected components of a graph given as rows of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import stored


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, component`` (the smallest node reachable) of undirected edges ``a, b`` between longs.

    Alternates the large-star and small-star steps: each node hands its larger, then its smaller neighbours to the
    smallest one it knows.  Every step is a grouped minimum (with a map-side combine, so a hub is one row per map task)
    and a join with it, and is written to the shared folder.  Nodes come from the edges; an edge may join a node to
    itself.
    """
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(rounds):
        seen = tuple(now.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))")).first())
        if seen == before or not seen[0]:
            break
        before = seen
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = stored(large.distinct(), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                                               F.struct(F.col("a"), F.col("m").alias("b")))).alias("e"))
        now = stored(small.select("e.*").where("a <> b").distinct(), "small-star")
    else:
        raise RuntimeError(f"no fixed point after {rounds} rounds")
    return nodes.join(now.select(F.col("a").alias("node"), F.col("b").alias("component")), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component"))
