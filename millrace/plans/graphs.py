"""Graph queries over parts and the customers who ordered them."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import graph
from millrace.plans import derived
from millrace.plans.catalog import query
from millrace.storage import materialize

_ROOT, _TARGET = 0, 2
_BFS = (
    derived.GRAPH
    + """,
bfs(id, d) AS (SELECT CAST(0 AS BIGINT), 0 UNION SELECT e.dst, b.d + 1 FROM bfs b JOIN edges e ON e.src = b.id WHERE b.d < 60),
levels AS (SELECT id, min(d) AS distance FROM bfs GROUP BY id)"""
)


@query(
    "gr_build_edges",
    f"WITH {derived.GRAPH} SELECT src, dst, coalesce(a.name, 'Nobody') AS src_name, coalesce(b.name, 'Nobody') AS dst_name FROM edges LEFT JOIN names a ON src = a.id LEFT JOIN names b ON dst = b.id",
)
def _(t):
    return graph.named_edges(graph.edges_from_lines(derived.graph_lines(t)), derived.graph_names(t))


@query(
    "gr_degree_topk",
    f"""WITH {derived.GRAPH}, ends AS (SELECT src AS id FROM edges UNION ALL SELECT dst FROM edges)
    SELECT d.id, degree, name FROM (SELECT id, count(*) AS degree FROM ends GROUP BY id ORDER BY degree DESC, id LIMIT 10) d LEFT JOIN names n ON d.id = n.id""",
)
def _(t):
    return graph.top_degrees(derived.graph_edges(t), derived.graph_names(t), 10)


@query(
    "gr_most_connected",
    f"""WITH {derived.GRAPH} SELECT d.id, connections, name FROM
    (SELECT src AS id, count(*) AS connections FROM edges GROUP BY src ORDER BY connections DESC, src DESC LIMIT 1) d LEFT JOIN names n ON d.id = n.id""",
)
def _(t):
    return graph.most_connected(derived.graph_lines(t), derived.graph_names(t))


@query(
    "gr_bfs_levels",
    f"WITH RECURSIVE {_BFS} SELECT v.id, coalesce(distance, 9999) AS distance FROM (SELECT DISTINCT src AS id FROM edges) v LEFT JOIN levels l ON v.id = l.id",
)
def _(t):
    edges = materialize(derived.graph_edges(t), "edges")
    return graph.distances(edges, edges.select(F.col("src").alias("id")).distinct(), _ROOT, stored=True)


@query(
    "gr_degrees_of_separation",
    f"""WITH RECURSIVE {_BFS} SELECT CAST({_ROOT} AS BIGINT) AS root, CAST({_TARGET} AS BIGINT) AS target, (SELECT distance FROM levels WHERE id = {_TARGET}) AS distance,
    (SELECT count(DISTINCT src) FROM edges JOIN levels ON src = id WHERE dst = {_TARGET} AND distance + 1 = (SELECT distance FROM levels WHERE id = {_TARGET})) AS hits""",
)
def _(t):
    return graph.separation(derived.graph_edges(t), _ROOT, _TARGET)
