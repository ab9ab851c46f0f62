"""Connected components of an edge table, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyseq.operators.skew import join_hot
from tallyseq.session import materialize


def _least(edges: DataFrame) -> DataFrame:
    """A node's smallest neighbour and the number of its neighbours, combined before the shuffle."""
    return edges.groupBy("src").agg(F.min("dst").alias("low"), F.count("*").alias("members"))


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = _least(both).withColumn("low", F.least("src", "low"))
    return join_hot(both.where("dst > src"), least, "src", 2 * total).select(F.col("dst").alias("src"), F.col("low").alias("dst"))


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = _least(edges)
    moved = join_hot(edges, least, "src", total).where("dst <> low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    return moved.union(least.select("src", F.col("low").alias("dst")))


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph.

    ``edges`` has two columns of one orderable type (``src``, ``dst``). Returns
    ``(node, component)`` with the smallest reachable node as component, for each
    node that has an edge to another one. Self loops, repeated edges and edges
    with a null end are ignored; an empty table gives an empty result.

    Large-star and small-star steps alternate until the edges stop changing, which
    takes a number of rounds that grows with the logarithm of the longest path. A
    node's minimum is combined before the shuffle. Edges of a hub meet the hub's
    minimum by broadcast: nodes whose degree passes a limit are at most a fixed
    number, so no task gets a neighbourhood of more edges than that limit.
    """
    edges = edges.toDF("src", "dst").where("src <> dst")
    edges = materialize(edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct())
    seen = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if seen is not None and tuple(now) == seen or now[0] == 0:
            return edges.select(F.col("src").alias("node"), F.col("dst").alias("component")).union(
                edges.select("dst", "dst").distinct()
            )
        seen = tuple(now)
        edges = materialize(_small_star(_large_star(edges, now[0]).where("src <> dst"), now[0]).distinct())
