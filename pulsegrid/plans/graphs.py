"""Graph queries over customers, suppliers and the orders between them."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsegrid.operators import graph
from pulsegrid.plans.registry import query
from pulsegrid.plans.tables import GRAPH, trade_graph


@query("graph_size", f"WITH {GRAPH} SELECT 'vertices' AS part, count(*) AS n FROM vx UNION ALL SELECT 'edges', count(*) FROM eg")
def graph_size(spark, sf):
    return graph.graph_size(*trade_graph(spark, sf))


@query("vertex_filter", f"WITH {GRAPH} SELECT id, name, age FROM vx WHERE age > 5000")
def vertex_filter(spark, sf):
    vertices, _ = trade_graph(spark, sf)
    return graph.vertex_filter(vertices, F.col("age") > 5000)


@query("edge_filter", f"WITH {GRAPH} SELECT src, dst, CAST(weight AS BIGINT) AS weight FROM eg WHERE weight > 1")
def edge_filter(spark, sf):
    _, edges = trade_graph(spark, sf)
    return edges.filter(F.col("weight") > 1)


@query(
    "triplets",
    f"""WITH {GRAPH} SELECT s.name AS src_name, d.name AS dst_name, CAST(weight AS BIGINT) AS weight FROM eg JOIN vx s ON src = s.id JOIN vx d ON dst = d.id""",
)
def triplets(spark, sf):
    vertices, edges = trade_graph(spark, sf)
    return graph.triplets(vertices, edges, ["name"]).select("src_name", "dst_name", "weight")


@query(
    "degrees",
    f"""WITH {GRAPH} SELECT id, name, coalesce(i, 0) AS in_degree, coalesce(o, 0) AS out_degree FROM vx
        LEFT JOIN (SELECT dst, count(*) AS i FROM eg GROUP BY 1) a ON id = dst LEFT JOIN (SELECT src, count(*) AS o FROM eg GROUP BY 1) b ON id = src""",
)
def degrees(spark, sf):
    vertices, edges = trade_graph(spark, sf)
    return graph.degrees(vertices, edges).select("id", "name", "in_degree", "out_degree")


@query(
    "oldest_follower",
    f"""WITH {GRAPH}, f AS (SELECT dst, s.name AS f, s.age AS a, row_number() OVER (PARTITION BY dst ORDER BY s.age DESC, s.name) AS r FROM eg JOIN vx s ON src = s.id)
        SELECT id, name, coalesce(f, 'none') AS follower, a AS follower_age FROM vx LEFT JOIN (SELECT * FROM f WHERE r = 1) x ON id = dst""",
)
def oldest_follower(spark, sf):
    return graph.oldest_follower(*trade_graph(spark, sf))


@query(
    "subgraph",
    f"""WITH {GRAPH} SELECT src, dst, CAST(weight AS BIGINT) AS weight FROM eg WHERE src IN (SELECT id FROM vx WHERE age > 3000) AND dst IN (SELECT id FROM vx WHERE age > 3000)""",
)
def subgraph(spark, sf):
    vertices, edges = trade_graph(spark, sf)
    return graph.subgraph(vertices, edges, F.col("age") > 3000)[1]
