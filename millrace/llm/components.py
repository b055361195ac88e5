"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is one aggregation and one join of stored tables, so a vertex with any number of edges
is split over tasks. The number of rounds follows the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.storage import materialize


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Link neighbours of each vertex to the least of them; ``small``: only those below the vertex."""
    both = edges if small else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # Here a is the vertex, b a neighbour; edges are stored with a > b.
    least = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
    stored = materialize(both, "neighbours")
    met = stored.join(least.withColumnRenamed("a", "_v"), F.col("a") == F.col("_v"))
    linked = met.filter("m != b") if small else met.filter("b > a")
    out = linked.select(F.col("b").alias("a"), F.col("m").alias("b"))
    if small:
        out = out.unionByName(least.filter("m != a").select("a", F.col("m").alias("b")))
    return materialize(out.filter("a > b").distinct(), "stars")


def components(edges: DataFrame) -> DataFrame:
    """``a``, ``b`` edges of comparable values in; ``vertex``, ``root`` out: root is the least of its component.

    Vertices without an edge to another vertex are not listed.
    """
    now = materialize(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "stars")
    before = None
    while True:
        now = _star(_star(now, small=False), small=True)
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    return now.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
