"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgestar.session import stage


def _linked_to_smallest(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node, and the node, linked to the smallest of node and neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    larger = both.where("b > a").join(smallest, "a").selectExpr("b AS a", "m AS b")
    return larger.where("a != b").distinct()


def _smaller_to_smallest(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node itself, linked to the smallest of them."""
    down = edges.selectExpr("greatest(a, b) AS a", "least(a, b) AS b")
    smallest = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(smallest, "a").selectExpr("b AS a", "m AS b").where("a != b")
    return moved.union(smallest.selectExpr("a", "m AS b")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)``; component is its smallest node.

    Alternates two local rules until the edges stay the same (Kiveris et al., 2014): only minima per
    node and joins, and each round is written to the shared folder, so neither a large component nor
    a lost executor matters. Edges from a node to itself name a node and link nothing. Null ends are
    ignored. An empty table has an empty result.
    """
    nodes = edges.where("a IS NOT NULL AND b IS NOT NULL").selectExpr(
        "cast(a AS long) AS a", "cast(b AS long) AS b"
    )
    given = stage(nodes.distinct(), "edges")
    current = given.where("a != b")
    seen = None
    while True:
        current = stage(_smaller_to_smallest(_linked_to_smallest(current)), "edges")
        state = current.agg(
            F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("a", "b")).alias("x"),
        ).first()
        if state == seen:
            break
        seen = state
    everyone = given.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    return everyone.join(current.withColumnRenamed("a", "node"), "node", "left").select(
        "node", F.coalesce("b", "node").alias("component")
    )
