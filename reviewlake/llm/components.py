"""Connected components of a table of links, without a list of any node's neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """(node, component) of each node of the (a, b) links; a component's name is its smallest node.

    Each round hooks every label to the smallest label it has a link with, doubles these pointers until
    each reaches its root, and rewrites links and labels; links inside one label go. So a
    chain takes one round. Minima are aggregated in each task before the shuffle, so a node with
    very many links is no hot group.
    """
    edges = cut_lineage(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                        .distinct(), "links")
    labels = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node"))
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("x"), F.least("a", "m").alias("p"))
        to = cut_lineage(to.where("x <> p"), "parents")          # a label without a row is its own parent
        moved = True
        while moved:
            up = to.select(F.col("x").alias("y"), F.col("p").alias("q"))
            to = cut_lineage(to.join(up, F.col("p") == F.col("y"), "left").select(
                "x", F.coalesce("q", "p").alias("p"), F.col("q").isNotNull().alias("moved")), "parents")
            moved = not to.where("moved").isEmpty()
        labels = cut_lineage(labels.join(to, F.col("component") == F.col("x"), "left")
                             .select("node", F.coalesce("p", "component").alias("component")), "labels")
        end = lambda c: to.select(F.col("x").alias(f"x{c}"), F.col("p").alias(f"p{c}"))  # noqa: B023, E731
        edges = cut_lineage(edges.join(end("a"), F.col("a") == F.col("xa"), "left").join(end("b"), F.col("b") == F.col("xb"), "left")
                            .select(F.coalesce("pa", "a").alias("a"), F.coalesce("pb", "b").alias("b"))
                            .where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                            .distinct(), "links")
    return labels
