"""Graph building, degrees and breadth-first search on edge tables."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.strings import adjacency_id, adjacency_neighbours, adjacency_tail
from millrace.operators.aggregates import argmax
from millrace.operators.joins import lookup_few
from millrace.storage import materialize


def lines_from_edges(edges: DataFrame, width: int = 512) -> DataFrame:
    """Distinct (src, dst) edges as ``id neighbour neighbour ... `` lines, neighbours in ascending order.

    A vertex fills one line per ``width`` consecutive ids among its neighbours, so no line is long and
    no hub is one task's. Such groups mostly hold one or two edges: they are sorted and joined by
    columns, since an aggregate of lists would keep an object for each. An edge without both ends has no line.
    """

    def lines(batches):
        src = dst = np.empty(0, np.int64)
        for batch in batches:
            src, dst = np.concatenate([src, batch.column(0).to_numpy()]), np.concatenate([dst, batch.column(1).to_numpy()])
            block = dst // width
            starts = np.flatnonzero(np.r_[True, (src[1:] != src[:-1]) | (block[1:] != block[:-1])])
            # The last line may go on in the next batch.
            yield joined(src, dst, starts)
            src, dst = src[starts[-1] :], dst[starts[-1] :]
        if len(src):
            yield joined(src, dst, np.array([0, len(src)]))

    def joined(src, dst, bounds):
        near = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(dst).cast(pa.string()))
        ids = pa.array(src[bounds[:-1]]).cast(pa.string())
        return pa.record_batch([pc.binary_join_element_wise(ids, pc.binary_join(near, " "), "", " ")], ["value"])

    both = edges.select(F.col("src").cast("bigint"), F.col("dst").cast("bigint")).dropna()
    dealt = both.repartition("src", F.col("dst") - F.pmod(F.col("dst"), F.lit(width))).sortWithinPartitions("src", "dst")
    return dealt.mapInArrow(lines, "value string")


def edges_from_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """``id neighbour neighbour ...`` lines as (src, dst); an id may fill several lines."""
    tokens = lines.select(adjacency_id(F.col(column)).alias("src"), F.explode(adjacency_tail(F.col(column))).alias("dst"))
    return tokens.select("src", F.col("dst").try_cast("bigint").alias("dst")).dropna()


def vertices(edges: DataFrame, names: DataFrame, default: str = "Nobody") -> DataFrame:
    """Every vertex that occurs in an edge, with its name or the default."""
    ids = edges.select(F.col("src").alias("id")).union(edges.select("dst")).distinct()
    named = ids.join(names.select(F.col("id").alias("_id"), "name"), F.col("id") == F.col("_id"), "left")
    return named.select("id", F.coalesce("name", F.lit(default)).alias("name"))


def named_edges(edges: DataFrame, names: DataFrame, default: str = "Nobody") -> DataFrame:
    """(src, dst, src_name, dst_name): the edges with the names of both ends, or the default.

    Both joins get plain exchanges of edges, so Spark can split a hub vertex.
    """
    for end in ("src", "dst"):
        named = names.select(F.col("id").alias(end), F.col("name").alias(f"{end}_name"))
        edges = edges.join(named, end, "left")
    return edges.select("src", "dst", *[F.coalesce(f"{end}_name", F.lit(default)).alias(f"{end}_name") for end in ("src", "dst")])


def degrees(edges: DataFrame) -> DataFrame:
    """Total degree (in + out) per vertex."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id"))
    return ends.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))


def top_degrees(edges: DataFrame, names: DataFrame, k: int = 10) -> DataFrame:
    top = degrees(edges).orderBy(F.desc("degree"), "id").limit(k)
    return lookup_few(top, names, "id", "id", ["name"]).orderBy(F.desc("degree"), "id")


def connection_counts(lines: DataFrame, column: str = "value") -> DataFrame:
    """Listed connections per id, summed over all its lines."""
    sized = lines.select(
        adjacency_id(F.col(column)).alias("id"), F.size(adjacency_neighbours(F.col(column))).alias("c")
    )
    return sized.filter(F.col("id").isNotNull()).groupBy("id").agg(F.sum("c").alias("connections"))


def most_connected(lines: DataFrame, names: DataFrame) -> DataFrame:
    """The id with most listed connections, with its name."""
    return lookup_few(argmax(connection_counts(lines), "connections", "id"), names, "id", "id", ["name"])


def bfs_levels(
    edges: DataFrame, root: int, max_depth: int | None = None, target: int | None = None, broadcast_rows: int = 100_000, stored: bool = False
) -> tuple[DataFrame, int | None, int]:
    """Distances from ``root`` along (src, dst): all of them, or up to ``max_depth`` if the caller asks.

    Returns ``(levels(id, distance), target distance, frontier vertices that reached it)`` and stops
    early once ``target`` is reached. One level costs one join of the frontier with the edges; the
    frontier is counted anyway, and is broadcast while that count is below ``broadcast_rows``.
    The edges are written to the shared folder once (``stored``: they are there already) and every
    level is added there, so no level derives the edges again and lineage stays one step long.
    """
    spark = edges.sparkSession
    edges = edges if stored else materialize(edges.select("src", "dst"), "edges")
    id_type = edges.schema["src"].dataType.simpleString()
    frontier = materialize(
        spark.range(1).select(F.lit(root).cast(id_type).alias("id"), F.lit(0).alias("distance")), "bfs"
    )
    seen, size, hits = frontier, 1, 0
    found = 0 if target == root else None
    for depth in itertools.count(1):
        if size == 0 or found is not None or (max_depth is not None and depth > max_depth):
            break
        heads = frontier.select(F.col("id").alias("src"))
        step = edges.join(F.broadcast(heads) if size <= broadcast_rows else heads, "src")
        if target is not None:
            step = materialize(step, "bfs_step")
            hits = step.filter(F.col("dst") == target).select("src").distinct().count()
            found = depth if hits else None
        reached = step.select(F.col("dst").alias("id")).distinct().join(seen.select("id"), "id", "left_anti")
        frontier = materialize(reached.withColumn("distance", F.lit(depth)), "bfs")
        size = frontier.count()
        seen = seen.union(frontier)
    return seen, found, hits


def distances(edges: DataFrame, all_vertices: DataFrame, root: int, max_depth: int | None = None, unreached: int = 9999, stored: bool = False) -> DataFrame:
    """Distance of every vertex; those not reached (within ``max_depth``, if given) get ``unreached``."""
    levels, _, _ = bfs_levels(edges, root, max_depth, stored=stored)
    return all_vertices.join(levels, "id", "left").withColumn("distance", F.coalesce("distance", F.lit(unreached)))


def separation(edges: DataFrame, root: int, target: int, max_depth: int | None = None) -> DataFrame:
    """One row: distance from root to target (null when not reached) and the frontier vertices that hit it."""
    _, found, hits = bfs_levels(edges, root, max_depth, target=target)
    row = [(root, target, found, hits)]
    return edges.sparkSession.createDataFrame(row, "root bigint, target bigint, distance int, hits bigint")
