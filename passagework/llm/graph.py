"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagework.session import write_once


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the least node reachable) for every node of the edges ``a``, ``b``.

    Alternates two steps that hang neighbours on the least one (after Kiveris et al.): the number of edges never grows,
    and the steps end after about the logarithm of the longest path. Nothing is gathered per node, and every round is a
    written table. Loops give a node of its own; null ends are left out.
    """
    edges = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a IS NOT NULL AND b IS NOT NULL")
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    links = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links, before = write_once(links), None
    while True:
        # larger neighbours hang on the least of all neighbours
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        far = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
        far = far.distinct()
        # smaller neighbours and the node itself hang on the least neighbour
        least = far.groupBy("a").agg(F.min("b").alias("m"))
        near = far.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        near = near.unionByName(least.withColumnRenamed("m", "b")).distinct()
        links = write_once(near)
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return nodes.join(links.withColumnRenamed("a", "node"), "node", "left").select(
        "node", F.coalesce("b", "node").alias("component"))
