"""Connected components by alternating large-star and small-star rounds.

Links stay a distributed table; each round regroups it by node and is written
to the shared folder. Only a row count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.base import written


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the component's smallest node."""
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "least")
        large = written(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "links")
        lowest = written(large.groupBy("a").agg(F.min("b").alias("m")), "lowest")
        moved = large.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(lowest.select("a", F.col("m").alias("b")).union(moved).distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())


def joined_components(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, root) of the components of earlier links, as ``labels``, and new ``links`` (a, b).

    Only roots take part: nodes of one component are one node of the new links.
    """
    if labels is None:
        return components(links)
    of = lambda c: labels.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
    known = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    between = known.select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b")).where("a <> b").distinct()
    merged = written(components(written(between, "root-links")), "root-labels")
    into = merged.select(F.col("node").alias("root"), F.col("root").alias("to"))
    old = labels.join(into, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return old.union(merged.join(labels.select("node"), "node", "left_anti").select("node", "root"))
