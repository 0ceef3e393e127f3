"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is a grouped minimum joined back; no node's links meet in one task or on the driver. The minimum is
written down first, so that adaptive execution can split the join on a node with very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable


def _star(links: DataFrame, large: bool) -> DataFrame:
    """``links``: u > v. Large: link all larger neighbours of a node to its least one; small: the node and its smaller ones.

    A large step makes no more rows than it takes, so repeated ones are left to the small step after it."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else links
    least = durable(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "component-least")
    met = both.join(least, "u")
    if large:
        return met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
    out = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def _is_settled(links: DataFrame) -> bool:
    """Whether every node has one link down, to a node that has none: then the steps change nothing any more."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up"))
    ends = ends.unionByName(links.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return nodes.agg(F.count_if((F.col("down") > 1) | ((F.col("down") > 0) & (F.col("up") > 0)))).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """``links``: a, b (long), in any order, repeated or not. Returns node, root (its component's least node); roots and
    nodes without links are not listed."""
    current = durable(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while True:
        current = durable(_star(durable(_star(current, True), "links-large"), False), "links-small")
        if _is_settled(current):
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))


def with_links(found: DataFrame, links: DataFrame) -> DataFrame:
    """The components ``found`` (as ``components`` returns them), further ``links`` put in."""
    if links.isEmpty():
        return found
    return components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(links))
