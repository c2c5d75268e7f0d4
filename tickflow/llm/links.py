"""Connected components of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.session import materialize


def join_dealt(rows: DataFrame, facts: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join ``rows`` with one row of ``facts`` per ``key``, where a key may be hot.

    ``facts`` often comes out of an aggregate by the key, and Spark would then keep that
    partitioning and could not split a hot key's rows. A second key column, which the
    first one determines, makes it deal out both sides for the join.
    """
    check = "_" + key + "_check"
    left = rows.withColumn(check, F.hash(key) % 2)
    right = facts.withColumn(check, F.hash(key) % 2)
    return left.join(right, [key, check], how).drop(check)


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with the least of u and its neighbours v as ``m``."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return join_dealt(edges, least, "u")


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every edge ties a node with no other edge to the root of its star."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("root"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
    wrong = F.sum("up") + F.max("root") > 1
    return ends.groupBy("node").agg(wrong.alias("wrong")).filter("wrong").isEmpty()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of distinct links: nodes with their component's smallest node.

    The smallest nodes themselves are left out. Large stars tie each node's larger
    neighbours to its least one, small stars its smaller ones; repeated until only stars
    are left, in rounds logarithmic in the number of nodes. Every round is a written
    table, so no lineage grows and lost executors cost one round. Links of a node to
    itself count for nothing.
    """
    first = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = first.filter("u > v")
    while not _is_star_forest(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least_neighbour(both).filter("v > u")
        down = large.select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _least_neighbour(down)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            small.select("u", F.col("m").alias("v"))
        )
        edges = materialize(small.filter("u > v").distinct(), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
