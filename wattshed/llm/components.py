"""Connected components of a graph given by its edges, in star-shaped rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattshed.llm.common import staged


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Hangs each larger neighbour of a vertex on the least vertex around it."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    met = both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b")
    return met.where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hangs a vertex and its smaller neighbours on the least of them."""
    down = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    met = down.join(least, "u").where("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return met.unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component) of every vertex with an edge; the component is its least vertex.

    edges has integers a and b; loops and repeats do no harm. Each round joins
    every edge to the least neighbour, found by partial aggregation, so a vertex
    with very many edges is split like any skewed join key. Rounds grow with the
    logarithm of the longest path; each is staged.
    """
    edges = staged(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges"
    )
    state = _state(edges)
    while state[0]:
        edges = staged(_small_star(_large_star(edges)), "edges")
        after = _state(edges)
        if after == state:
            break
        state = after
    roots = edges.select(F.col("a").alias("vertex"), F.col("a").alias("component")).distinct()
    return edges.select(F.col("b").alias("vertex"), F.col("a").alias("component")).unionByName(roots)
