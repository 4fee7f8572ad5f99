"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.common import Scratch, written


def _settled(links: DataFrame) -> bool:
    """Whether the links are stars: no node has two smaller neighbours, or a smaller and a larger one."""
    ends = links.select(F.col("a").alias("u"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(links.select(F.col("b").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    sums = ends.groupBy("u").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return sums.where("up > 1 or (up > 0 and down > 0)").isEmpty()


def _large_star(links: DataFrame, keep: Scratch) -> DataFrame:
    """Every node hands its smallest neighbour (or itself) to its larger neighbours."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = keep.put(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "star")
    return links.join(least, links["b"] == least["u"]).select("a", F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame, keep: Scratch) -> DataFrame:
    """Every node and its smaller neighbours link to the smallest of them."""
    least = keep.put(links.groupBy("a").agg(F.min("b").alias("m")), "star")
    moved = links.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` of comparable ids → ``(node, root)``, root the smallest id reachable.

    Nodes without a link don't appear. Null ends and links of a node to itself
    are ignored; repeated links count once; an empty table gives an empty one.
    The rounds grow with the logarithm of the longest chain. Each round is a
    group-by with partial aggregation and one join of two written tables, whose
    hot keys AQE splits; the driver only learns whether the links are stars by now.
    A round's tables are deleted when the next one's are written.
    """
    keep = Scratch(links.sparkSession)
    links = keep.put(links.where("a is not null and b is not null and a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not _settled(links):
        links = keep.put(_large_star(links, keep), "large")
        links = keep.put(_small_star(links, keep), "links")
    found = written(links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()), "components")
    keep.drop("links", "large", "star")
    return found
