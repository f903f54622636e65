"""Connected components of an edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex is tied to the vertex's smallest neighbour."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A vertex and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.select("u", F.col("m").alias("v")).union(moved).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``vertex, root`` for every vertex of ``edges(u, v)``: root is the smallest vertex that can be reached.

    No vertex's neighbours are gathered: minima are aggregated before the
    shuffle, and joins on a hot vertex can be split. Each round is a written
    table. NULL ends and loops are left out; no edges give no rows.
    """
    edges = stage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct(), "components")
    before = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if state == before:
            break
        before = state
        if not state["n"]:
            break
        edges = stage(_small_star(_large_star(edges)), "components")
    return edges.select(F.col("u").alias("vertex"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
