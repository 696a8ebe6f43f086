"""Connected components of a distributed edge list by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.frames import written


def _least(pairs: DataFrame, key: str, other: str) -> DataFrame:
    return pairs.groupBy(key).agg(F.min(other).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Ties every larger neighbour of a vertex to the least vertex around it."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both, "u", "v").select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Ties a vertex and its smaller neighbours to the least of them."""
    least = _least(edges, "u", "v")
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``vertex``, ``component`` (its least vertex) of every vertex with an edge.

    Two rounds of stars at a time until the edge list stands still; each round
    is a table in the shared folder, so no lineage grows and no edge reaches
    the driver. Self links and repeated links change nothing; no edges, no rows.
    """
    current = written(
        edges.where(f"{a} IS NOT NULL AND {b} IS NOT NULL AND {a} != {b}")
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "edges",
    )
    before = None
    while True:
        # A star forest is a fixed point of both steps; equal sums of the
        # edges' hashes and equal counts say that nothing moved.
        state = current.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
        ).first()
        if tuple(state) == before or state[0] == 0:
            return current.select(F.col("u").alias("vertex"), F.col("v").alias("component")).union(
                current.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
            )
        before = tuple(state)
        current = written(_small_star(_large_star(current).distinct()).distinct(), "edges")
