"""Connected components of a link table by alternating stars: every step is a join and a grouped minimum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.frames import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the larger (large star) or the smaller and equal (small star) neighbours of a node on its least neighbour."""
    if large:
        edges = _both_ways(edges)
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    least = least.withColumn("m", F.least("a", "m"))
    hung = edges.join(least, "a")
    if large:
        hung = hung.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        hung = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return hung.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of the edges ``a, b``; the root is the least node of its component.

    Nothing but a count and a checksum per round reaches the driver. The number of rounds grows with
    the logarithm of the number of nodes.
    """
    down = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    at, seen = stored(down.distinct(), "links"), None
    while True:
        state = at.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        at = stored(_star(_star(at, large=True), large=False), "links")
    return at.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        at.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
