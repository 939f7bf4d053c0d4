"""Connected components by alternating large-star and small-star (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.storage import land, release


def _star(edges: DataFrame) -> DataFrame:
    """Every edge (u, v) becomes (v, m) with m the least neighbour of u, u itself counted."""
    return edges.join(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "u")


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) of every end of ``links`` (a, b), landed; the component is its smallest node.

    Each star is a minimum per node (a partial aggregate) and a join on the node that Spark can split, so a
    node with very many neighbours isn't one task's work. Rounds are written to the shared folder and removed after the next.
    """
    edges = land(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        last = edges
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = land(large.distinct(), "large")
        small = _star(large)
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        edges = land(small.distinct(), "edges")
        release(last, large)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            out = edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
            out = land(out, "components")
            release(edges)
            return out
        before = now
    raise RuntimeError(f"components have not converged in {most_rounds} rounds")
