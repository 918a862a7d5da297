"""Connected components of edges, by DataFrame steps on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node of its connected component, for all nodes of the edges (a, b).

    Alternates the large-star and small-star steps on written tables until all
    edges form stars: no node has two smaller neighbours, and none is both the
    larger end of an edge and the smaller end of another.  Minima are taken
    map-side before they are joined back.
    """
    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges if not large else edges.union(edges.select("b", "a"))
        # small: each node (the larger end) with its smaller neighbours
        least = stage(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")
        out = both.join(least, "a")
        if large:
            out = out.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = out.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        return out.where("a != b").distinct()

    edges = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "edges")
    while True:
        edges = stage(star(star(edges, True), False), "stars")
        ends = edges.select(F.inline(F.array(
            F.struct(F.col("a").alias("node"), F.lit(1).alias("up")), F.struct(F.col("b").alias("node"), F.lit(0).alias("up")))))
        ups = ends.groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
        if ups.where("up > 1 or (up = 1 and least = 0)").count() == 0:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct()
