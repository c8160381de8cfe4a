"""Connected components of a graph of links, by alternating stars over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postings.sources.warehouse import intermediates, stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with a link; the component is its smallest node.

    Every round links each node's larger neighbours to its smallest one, then each
    node's smaller neighbours to the smallest, until nothing changes. A hub's
    links are spread by its neighbours: the smallest neighbour is a pre-aggregated
    minimum joined back, so no task holds all neighbours of a node. Self-links and repeated links are
    harmless; NULL ends are dropped. Only the last round's links stay written.
    """
    with intermediates() as made:
        edges = stored(_clean(links.select(F.col(a).alias("a"), F.col(b).alias("b"))))
        before = None
        while True:
            # Large star: every larger neighbour of a node goes to the node's smallest neighbour or itself.
            both = edges.union(edges.select(F.col("b"), F.col("a")))
            least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
            large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            # Small star: every smaller neighbour of a node, and itself, goes to its smallest neighbour.
            down = stored(_clean(large))
            least = down.groupBy(F.col("a")).agg(F.min("b").alias("m"))
            small = down.join(least, "a").select(F.col("b").alias("x"), "m").union(least.select(F.col("a").alias("x"), "m"))
            edges = stored(_clean(small.toDF("a", "b")))
            made.drop(edges)
            state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
            if state == before:
                break
            before = state
    heads = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).union(heads)


def _clean(edges: DataFrame) -> DataFrame:
    """Each link once, from its larger to its smaller end."""
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
