"""Connected components of a graph of links, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``links`` (a, b).

    Alternating large-star and small-star steps (Kiveris et al.): each node's larger neighbours are hung under its
    smallest neighbour, then its smaller ones. Groups are only aggregated (``min``) and joined back, never collected, and
    Spark splits the skewed side of the joins. Every round is a written table, so a lost executor costs one round; the
    number of rounds grows with the logarithm of the number of nodes.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    edges = materialize(edges)
    while True:
        both = edges.union(edges.select("b", "a"))
        smallest = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        # Large star: larger neighbours of n go under m(n).
        large = edges.join(smallest, edges["b"] == smallest["n"]).select("a", F.col("m").alias("b")).filter("a > b").distinct()
        # Small star: smaller neighbours of n, and n, go under the smallest of them.
        under = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
        small = large.join(under, large["a"] == under["n"]).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b")
        after = materialize(under.select(F.col("n").alias("a"), F.col("m").alias("b")).union(small).distinct())
        # A forest of stars: nobody who is a parent has a parent.
        parents = after.select(F.col("b").alias("a")).distinct()
        edges = after
        if after.join(parents, "a", "left_semi").isEmpty() and after.groupBy("a").count().filter("count > 1").isEmpty():
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
