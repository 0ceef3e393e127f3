"""Connected components per group, by alternating large-star and small-star steps.

A step links the neighbours of a node to the least node around it; the number of steps grows with the logarithm of the
longest path, not with its length. Every step is a grouped minimum, written down and joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable


def _large_star(links: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``links``: keys, up > low. Every larger neighbour of a node is linked to the least node around it."""
    both = links.unionByName(links.select(*keys, F.col("low").alias("up"), F.col("up").alias("low")))
    least = both.groupBy(*keys, "up").agg(F.min("low").alias("least")).withColumn("least", F.least("up", "least"))
    met = both.join(durable(least, "component-least"), [*keys, "up"]).where("low > up")
    return met.select(*keys, F.col("low").alias("up"), F.col("least").alias("low")).where("up > low").distinct()


def _small_star(links: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every node and its smaller neighbours are linked to the least of these."""
    least = durable(links.groupBy(*keys, "up").agg(F.min("low").alias("least")), "component-least")
    met = links.join(least, [*keys, "up"]).select(*keys, F.col("low").alias("up"), F.col("least").alias("low"))
    return met.unionByName(least.select(*keys, "up", F.col("least").alias("low"))).where("up > low").distinct()


def _settled(links: DataFrame, keys: Sequence[str]) -> bool:
    """Whether every node has one link down, to a node that has none."""
    downs = links.groupBy(*keys, F.col("up").alias("node")).agg(F.count("*").alias("downs"))
    ends = links.select(*keys, F.col("low").alias("node")).distinct().withColumn("is_end", F.lit(True))
    met = downs.join(ends, [*keys, "node"], "left")
    return met.where("downs > 1 OR is_end").isEmpty()


def components(links: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, int]:
    """(keys, node, label: the least node connected to it; rounds needed). ``links``: keys, a, b in any order."""
    up, low = F.greatest("a", "b").alias("up"), F.least("a", "b").alias("low")
    nodes = links.select(*keys, F.col("a").alias("node")).unionByName(links.select(*keys, F.col("b").alias("node"))).distinct()
    current, rounds = durable(links.select(*keys, up, low).where("up > low").distinct(), "component-links"), 0
    while not _settled(current, keys):
        rounds += 1
        current = durable(_small_star(durable(_large_star(current, keys), "component-large"), keys), "component-small")
    roots = current.select(*keys, F.col("up").alias("node"), F.col("low").alias("label"))
    return nodes.join(roots, [*keys, "node"], "left").withColumn("label", F.coalesce("label", "node")), rounds
