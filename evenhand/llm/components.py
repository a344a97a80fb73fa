"""Connected components of links between documents, by alternating large and small stars.

Every round moves all links closer to the smallest node of their component, in two grouped steps; rounds end when
nothing moves. Links are written to the shared folder after each round, which cuts the lineage. No node's links come
together in one task: minima are taken by partial aggregation and joined back to the links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenhand.llm.common import written


def _fingerprint(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def _star(links: DataFrame, smaller: bool) -> DataFrame:
    """Link neighbours of each node ``u`` to the smallest of them (and of ``u``): its larger or its smaller ones."""
    if smaller:
        sides = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        sides = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
    least = sides.groupBy("u").agg(F.min("v").alias("least")).withColumn("least", F.least("u", "least"))
    moved = sides.join(least, "u")
    if smaller:
        moved = moved.select(F.col("v").alias("a"), F.col("least").alias("b")).union(least.select("u", "least"))
    else:
        moved = moved.filter("v > u").select(F.col("v").alias("a"), F.col("least").alias("b"))
    return moved.filter("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node that links reach."""
    links = written(links.select("a", "b").filter("a != b").distinct(), "links")
    before = _fingerprint(links)
    while before[0]:
        links = written(_star(_star(links, smaller=False), smaller=True), "links")
        now = _fingerprint(links)
        if now == before:
            break
        before = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("root"))
    ).distinct()
