"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalframe.plans.staging import stage


def _half(links: DataFrame, large: bool) -> DataFrame:
    """Link every neighbour that is larger (or else smaller) than a node to the node's smallest one."""
    if large:
        near = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = links
    least = stage(near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    joined = near.join(least, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def connected(links: DataFrame) -> DataFrame:
    """The smallest node that each linked node (a, b) can reach: node, component.

    Every round replaces the links by stars around the smallest neighbours, so
    that a chain of n links takes about log n rounds.  Each round is written to
    the shared folder.  Nodes without links are not returned; no links, no
    rows.  Runs jobs.
    """
    links = stage(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while True:
        # done when every larger node has one link, to a node that links to nothing smaller
        starry = links.groupBy("u").agg(F.count("*").alias("n"))
        roots = links.select(F.col("v").alias("u")).distinct()
        if starry.filter("n > 1").isEmpty() and links.join(roots, "u", "left_semi").isEmpty():
            break
        links = stage(_half(_half(links, True), False), "links")
    members = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stage(members.union(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()), "components")
