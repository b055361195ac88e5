from collections import deque
import random

from pyspark.sql import functions as F

from conftest import rows
from millrace.operators import graph


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "src bigint, dst bigint")


DIAMOND = [(1, 2), (1, 3), (2, 4), (3, 4)]


def test_bfs_diamond(spark):
    e = edges(spark, DIAMOND)
    v = spark.createDataFrame([(i,) for i in range(1, 6)], "id bigint")
    assert rows(graph.distances(e, v, 1)) == [(1, 0), (2, 1), (3, 1), (4, 2), (5, 9999)]
    assert rows(graph.separation(e, 1, 4)) == [(1, 4, 2, 2)]
    assert rows(graph.separation(e, 1, 1)) == [(1, 1, 0, 0)]
    assert rows(graph.separation(e, 4, 1)) == [(4, 1, None, 0)]


def test_depth_limit(spark):
    chain = edges(spark, [(i, i + 1) for i in range(20)])
    v = spark.createDataFrame([(i,) for i in range(21)], "id bigint")
    got = dict(rows(graph.distances(chain, v, 0, max_depth=3)))
    assert [got[i] for i in range(5)] == [0, 1, 2, 3, 9999]


def test_bfs_matches_a_queue_with_a_hub(spark):
    rng = random.Random(5)
    pairs = {(0, i) for i in range(1, 120)} | {(rng.randrange(200), rng.randrange(200)) for _ in range(300)}
    near = {}
    for a, b in pairs:
        near.setdefault(a, []).append(b)
    dist, todo = {7: 0}, deque([7])
    while todo:
        a = todo.popleft()
        for b in near.get(a, ()):
            if b not in dist:
                dist[b] = dist[a] + 1
                todo.append(b)
    e = edges(spark, sorted(pairs))
    for limit in (100_000, 0):  # broadcast frontier, shuffled frontier
        levels, _, _ = graph.bfs_levels(e, 7, max_depth=30, broadcast_rows=limit)
        assert dict(rows(levels)) == dist


def test_lines_to_edges_names_and_degrees(spark):
    lines = spark.createDataFrame([("5 6 7 ",), ("5 8",), ("6 5",), ("",)], "value string")
    e = graph.edges_from_lines(lines)
    assert rows(e) == [(5, 6), (5, 7), (5, 8), (6, 5)]
    names = spark.createDataFrame([(5, "FIVE"), (6, "SIX")], "id bigint, name string")
    assert rows(graph.vertices(e, names)) == [(5, "FIVE"), (6, "SIX"), (7, "Nobody"), (8, "Nobody")]
    assert rows(graph.degrees(e)) == [(5, 4), (6, 2), (7, 1), (8, 1)]
    assert rows(graph.most_connected(lines, names)) == [(5, 3, "FIVE")]
    assert graph.top_degrees(e, names, 2).count() == 2
    assert graph.connection_counts(lines).agg(F.sum("connections")).first()[0] == e.count()


def test_lines_go_on_over_batches_and_hubs_get_many_lines(spark):
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    pairs = [(0, i) for i in range(1, 2000)] + [(i, 0) for i in range(1, 2000)] + [(7, 512), (7, -1), (-3, 5), (2**60, 2**60 + 1), (2**60, 2**60 + 511)]
    try:
        spark.conf.set(size, "7")
        lines = [r.value for r in graph.lines_from_edges(edges(spark, [*pairs, (None, 4), (4, None)])).collect()]
    finally:
        spark.conf.set(size, before)
    wanted = {}
    for a, b in sorted(pairs):
        wanted.setdefault((a, b // 512), [a]).append(b)
    assert sorted(lines) == sorted(" ".join(map(str, ids)) + " " for ids in wanted.values())
    assert rows(graph.edges_from_lines(spark.createDataFrame([(v,) for v in lines], "value string"))) == sorted(pairs)
    assert graph.lines_from_edges(edges(spark, [])).count() == 0


def test_lines_with_odd_tokens(spark):
    odd = ["  5   6  7", "5 a 6", "5 1.5  99999999999999999999 7 ", "a 5", "5", " ", None, "-5 -6 +7"]
    lines = spark.createDataFrame([(v,) for v in odd], "value string")
    assert rows(graph.edges_from_lines(lines)) == [(-5, -6), (-5, 7), (5, 6), (5, 6), (5, 7), (5, 7)]
    assert rows(graph.connection_counts(lines)) == [(-5, 2), (5, 4)]


def test_names_of_both_ends(spark):
    names = spark.createDataFrame([(5, "FIVE"), (6, None), (9, "NINE")], "id bigint, name string")
    got = rows(graph.named_edges(edges(spark, [(5, 6), (6, 5), (7, 5), (7, 7)]), names))
    assert got == [(5, 6, "FIVE", "Nobody"), (6, 5, "Nobody", "FIVE"), (7, 5, "Nobody", "FIVE"), (7, 7, "Nobody", "Nobody")]
