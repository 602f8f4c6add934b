"""Property graphs as two tables: vertices (``id``, attributes) and edges (``src``, ``dst``, ``weight``)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def graph_size(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    counts = [vertices.agg(F.lit("vertices").alias("part"), F.count("*").alias("n"))]
    counts.append(edges.agg(F.lit("edges").alias("part"), F.count("*").alias("n")))
    return reduce(DataFrame.unionByName, counts)


def vertex_filter(vertices: DataFrame, condition: Column) -> DataFrame:
    return vertices.filter(condition)


def triplets(vertices: DataFrame, edges: DataFrame, attributes: list[str]) -> DataFrame:
    """Each edge with the attributes of both ends."""
    source = vertices.select(F.col("id").alias("src"), *[F.col(a).alias(f"src_{a}") for a in attributes])
    target = vertices.select(F.col("id").alias("dst"), *[F.col(a).alias(f"dst_{a}") for a in attributes])
    return edges.join(source, "src").join(target, "dst")


def degrees(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """In- and out-degree of every vertex, 0 where it has no edge; both ends from one pass."""
    ends = edges.select(
        F.explode(
            F.array(
                F.struct(F.col("src").alias("id"), F.lit(0).alias("i"), F.lit(1).alias("o")),
                F.struct(F.col("dst").alias("id"), F.lit(1).alias("i"), F.lit(0).alias("o")),
            )
        ).alias("e")
    )
    counted = ends.groupBy("e.id").agg(F.sum("e.i").alias("in_degree"), F.sum("e.o").alias("out_degree"))
    zero = F.lit(0).cast("long")
    return vertices.join(counted, "id", "left").select(
        *vertices.columns,
        F.coalesce("in_degree", zero).alias("in_degree"),
        F.coalesce("out_degree", zero).alias("out_degree"),
    )


def oldest_follower(vertices: DataFrame, edges: DataFrame, name: str = "name", age: str = "age") -> DataFrame:
    """For each vertex the follower (source of an incoming edge) of greatest age; equal ages by the
    smallest name; ``follower`` is ``none`` without one.

    A least value does not change with parallel edges and is taken partially before the shuffle, so a
    vertex with very many followers costs no more than another.
    """
    sources = vertices.select(F.col("id").alias("src"), F.col(age).alias("a"), F.col(name).alias("f"))
    first = F.min(F.struct((-F.col("a")).alias("o"), "f", "a"))
    best = edges.select("src", "dst").join(sources, "src").where("a is not null").groupBy("dst").agg(first.alias("m"))
    return vertices.join(best, F.col("id") == F.col("dst"), "left").select(
        "id",
        F.col(name),
        F.coalesce(F.col("m.f"), F.lit("none")).alias("follower"),
        F.col("m.a").alias("follower_age"),
    )


def subgraph(vertices: DataFrame, edges: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Vertices that meet a condition and the edges with both ends among them."""
    kept = vertices.filter(condition)
    ids = kept.select("id")
    inner = edges.join(ids, F.col("src") == ids["id"], "left_semi").join(ids, F.col("dst") == ids["id"], "left_semi")
    return kept, inner
