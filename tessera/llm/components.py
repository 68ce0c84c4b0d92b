"""Connected components over links, by alternating large and small stars.

Each round is two grouped minima with a join each; the links of a round are
written to the shared folder, so a lost executor repeats one round at most and
the plan does not grow. Nothing is collected but two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut, discard


def _large_star(edges: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """Link every larger neighbour of a node to the node's least neighbour.

    The minima are written before they are joined: both sides of the join are
    then plain exchanges, so Spark can split a node that holds many links.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = cut(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), label)
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), least


def _small_star(edges: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """Link a node and its smaller neighbours to the least of them; edges run from larger to smaller."""
    least = cut(edges.groupBy("a").agg(F.min("b").alias("m")), label)
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), least


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one link and no centre has one: the links then are the answer."""
    n, nodes = edges.agg(F.count("*"), F.countDistinct("a")).first()
    return n == nodes and edges.join(edges.select(F.col("a").alias("b")), "b", "left_semi").isEmpty()


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(a, b): each linked node ``a`` but the least of its component, with that least node ``b``.

    ``edges`` has columns a and b of one orderable type, no nulls, in any
    direction, repeated or not; links of a node to itself are ignored.
    """
    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    while not _are_stars(e):
        large, one = _large_star(e, label)
        large = cut(large, label)
        small, two = _small_star(large, label)
        now = cut(small, label)
        for old in (e, one, large, two):
            discard(old)
        e = now
    return e
