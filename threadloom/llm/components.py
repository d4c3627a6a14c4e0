"""Connected components of links, by alternating large-star and small-star rounds over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from threadloom.llm.common import store


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of links (a long, b long); root is the smallest node that can be reached.

    Each round joins edges with one minimum per node, so no list of neighbours is built. Loops and repeated links are
    fine; nodes without links are not returned. Rounds grow with the logarithm of the longest path.
    """
    edges = store(_oriented(links.select("a", "b")), "edges")
    for _ in range(max_rounds):
        if _are_stars(edges):
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        edges = store(_small_star(_large_star(edges)), "edges")
    raise RuntimeError(f"components did not settle within {max_rounds} rounds")


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour that has none itself, which then is the smallest of its component."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("lower"), F.lit(0).alias("upper"))
    ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("lower"), F.lit(1).alias("upper")))
    nodes = ends.groupBy("node").agg(F.sum("lower").alias("lower"), F.max("upper").alias("upper"))
    return nodes.where("lower > 1 or lower = 1 and upper = 1").isEmpty()


def _oriented(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller node."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour, itself included."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return _oriented(both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    moved = edges.join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _oriented(moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))))
