"""Exact top-k search by inner product: cover trees over queries and data, walked together.

Vectors are dealt to cells by the nearest of a few pivots, and a cell with more rows than a block is
dealt again by pivots of its own, until every cell is a block. So there are more and narrower cells the
more rows there are. Only what pivots cannot part (copies of one vector) is cut by a hash. Each block of
data and of queries becomes a cover tree in a file of the index. Scales shrink by a fixed base from level
to level: the members of a child are within its level's scale of its centre, children of one node are
further apart than that, and a member goes to the nearest child. Every node knows its covering radius
and its largest norm. With c, r, n for these, a pair of nodes can score at most the least of

* <c_q, c_x> + |c_q| r_x + |c_x| r_q + r_q r_x,
* (n_q^2 + n_x^2 - max(0, |c_q - c_x| - r_q - r_x)^2) / 2, and
* n_q n_x.

If that is below the worst k-th score of the queries in the group, the pair is left out. A query node
goes down with the set of all data nodes that may still matter to it. Blocks are first searched in their
own cell, which gives every query a k-th score to start from, and then against all other blocks that may matter.

Components become floor(scale * x), so scores are whole numbers; equal scores go by smaller id.
Defined results: rows whose id or vector is null, or whose vector holds a null or a non-finite
component, take no part; vectors meet only vectors of their own length; rows of a query's id are
its own and no candidates; an empty vector scores 0. Scores beyond 64 bits count as the largest
or smallest long. Repeated rows of a candidate each stand for themselves. Equal rows of a query
count once; a query id with several vectors gets the best of what each of them finds, so a candidate
may be there once for each. Vectors too long for their distances to be finite are compared one by one.
An empty table gives an empty table. Other columns are not looked at.
"""

from __future__ import annotations

import io
import math
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared_files import make_folder, new_file, open_file
from millrace.llm.support import ship
from millrace.operators.ranking import top_per_key
from millrace.storage import materialize, scratch_path

K = 5
SCALE = 256
PIVOTS = 24
BLOCK_ROWS = 8192
QUERY_ROWS = 1024
LEAF = 8
BASE = 1.3
LOWEST = -(1 << 63)
EXACT = float(1 << 53)


@dataclass
class Tree:
    """Points in tree order; node i holds points ``begin[i]:end[i]``, its children are ``first[i]:last[i]``.

    ``scale`` is what a node's members are known to be within of its centre by its level, ``radius`` the distance found.
    """

    ids: np.ndarray
    points: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    scale: np.ndarray
    norm: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray
    last: np.ndarray

    def save(self, path: str) -> None:
        held = io.BytesIO()
        np.savez(held, **self.__dict__)
        with new_file(path) as out:
            out.write(held.getvalue())

    def depth(self) -> int:
        """Nodes on the longest way down; children stand behind their parents."""
        level = np.ones(len(self.radius), np.int64)
        for n in range(len(level)):
            level[self.first[n] : self.last[n]] = level[n] + 1
        return int(level.max(initial=0))


def load_tree(path: str) -> Tree:
    with open_file(path) as stream:
        return Tree(**np.load(io.BytesIO(stream.read())))


def norms(points: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.sqrt((points * points).sum(1))


def separated(points: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of points more than ``scale`` apart, the first point among them, and for every point the place of the nearest."""
    chosen, left = [], np.arange(len(points))
    nearest, gap = np.zeros(len(points), np.int64), np.full(len(points), np.inf)
    while len(left):
        far = norms(points[left] - points[left[0]])
        chosen.append(int(left[0]))
        left = left[far > scale]
    for place, one in enumerate(chosen):
        far = norms(points - points[one])
        closer = far < gap
        nearest[closer], gap[closer] = place, far[closer]
    return np.array(chosen), nearest


def build_tree(ids: np.ndarray, points: np.ndarray, leaf: int = LEAF, base: float = BASE) -> Tree:
    """Cover tree of all points; only a node of at most ``leaf`` points, or of copies of one point, has no children."""
    nodes: list[tuple] = []
    radius = float(norms(points - points[0]).max()) if len(points) else 0.0
    # Breadth first, so that the children of a node stand next to each other.
    queue = [(0, np.arange(len(points)), radius, radius)] if len(points) else []
    at = 0
    while at < len(queue):
        centre, members, radius, scale = queue[at]
        if len(members) <= leaf or not 0 < radius < np.inf:
            nodes.append((centre, radius, scale, 0, 0, members))
        else:
            # The largest scale of the ladder below the radius: levels that would have one child are left out.
            below = base ** (math.ceil(math.log(radius, base)) - 1)
            while below >= radius:
                below /= base
            ordered = np.concatenate([[centre], members[members != centre]])
            inside = points[ordered]
            chosen, nearest = separated(inside, below)
            nodes.append((centre, radius, scale, len(queue), len(queue) + len(chosen), None))
            by_child = np.argsort(nearest, kind="stable")
            cuts = np.searchsorted(nearest[by_child], np.arange(len(chosen) + 1))
            for place, one in enumerate(chosen.tolist()):
                own = by_child[cuts[place] : cuts[place + 1]]
                queue.append((int(ordered[one]), ordered[own], float(norms(inside[own] - inside[one]).max()), below))
            queue[at] = None
        at += 1
    order: list[int] = []
    spans = [None] * len(nodes)
    stack = [(0, False)] if nodes else []
    while stack:
        n, opened = stack.pop()
        _, _, _, first, last, members = nodes[n]
        if members is not None:
            spans[n] = (len(order), len(order) + len(members))
            order += members.tolist()
        elif opened:
            spans[n] = (spans[first][0], spans[last - 1][1])
        else:
            stack.append((n, True))
            stack += [(c, False) for c in range(last - 1, first - 1, -1)]
    placed = np.array(order, np.int64)
    begin, end = (np.array([s[i] for s in spans], np.int64) for i in (0, 1))
    centres = points[[n[0] for n in nodes]] if nodes else points[:0]
    lengths = norms(points[placed])
    most = np.array([lengths[a:b].max() for a, b in zip(begin, end)])
    return Tree(
        ids[placed], points[placed], centres, np.array([n[1] for n in nodes]), np.array([n[2] for n in nodes]), most,
        begin, end, np.array([n[3] for n in nodes], np.int64), np.array([n[4] for n in nodes], np.int64),
    )


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-numbered vectors, as longs."""
    if norms(a).max(initial=0) * norms(b).max(initial=0) < EXACT and np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(a.shape[1], 1) < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = np.array([[int(x) for x in row] for row in a], object).reshape(a.shape) @ np.array([[int(x) for x in row] for row in b], object).reshape(b.shape).T
    return np.array([[min(max(int(v), -(1 << 63)), (1 << 63) - 1) for v in row] for row in whole], np.int64).reshape(len(a), len(b))


class Best:
    """The k best (score, smaller id first) of each query of a tree so far; no score below ``floor`` is wanted."""

    def __init__(self, queries: Tree, k: int, floor: np.ndarray | None = None):
        self.k = k
        self.rows: list[list[tuple[int, int]]] = [[] for _ in queries.ids]
        self.floor = np.full(len(queries.ids), LOWEST, np.int64) if floor is None else floor.copy()
        self.scored = 0

    def offer(self, at: int, own: int, ids: np.ndarray, scores: np.ndarray) -> None:
        some = np.flatnonzero((scores >= self.floor[at]) & (ids != own))
        if not len(some):
            return
        if len(some) > 4 * self.k:
            least = np.partition(scores[some], len(some) - self.k)[len(some) - self.k]
            some = some[scores[some] >= least]
        merged = sorted([*self.rows[at], *zip([-s for s in scores[some].tolist()], ids[some].tolist())])[: self.k]
        self.rows[at] = merged
        if len(merged) == self.k:
            self.floor[at] = max(self.floor[at], -merged[-1][0])


def bounds(queries: Tree, q: int, data: Tree, xs: np.ndarray) -> np.ndarray:
    """What no score of node ``q`` with the nodes ``xs`` exceeds; not a number where that cannot be told."""
    centre, radius, norm = queries.centre[q], queries.radius[q], queries.norm[q]
    centres, radii, most = data.centre[xs], data.radius[xs], data.norm[xs]
    with np.errstate(all="ignore"):
        dot = centres @ centre
        own, theirs = norms(centre[None])[0], norms(centres)
        slack = 1e-9 * (own + radius + theirs + radii) ** 2 + 1e-6
        by_centre = dot + own * radii + theirs * radius + radius * radii
        apart = np.maximum(np.sqrt(np.maximum(own**2 + theirs**2 - 2 * dot - slack, 0)) - radius - radii, 0)
        by_distance = (norm**2 + most**2 - apart**2) / 2
        return np.minimum(np.minimum(by_centre, by_distance), norm * most) + slack


def _spans(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers from each begin up to its end, one after another."""
    lengths = end - begin
    return np.repeat(end - np.cumsum(lengths), lengths) + np.arange(lengths.sum())


def _first_floors(queries: Tree, data: Tree, best: Best, most: int = 256) -> None:
    """Floors from different points of the data, the centres of nodes that stand side by side; their rows come later."""
    wide = np.array([0])
    while True:
        inner = data.first[wide] < data.last[wide]
        below = np.concatenate([wide[~inner], _spans(data.first[wide[inner]], data.last[wide[inner]])])
        if not inner.any() or len(below) > most:
            break
        wide = below
    if not inner.any():
        return
    # The children of one node have different points as centres, as do nodes side by side.
    below = below[:: max(1, len(below) // most)]
    at = data.begin[below]
    scores, ids = products(queries.points, data.points[at]), data.ids[at]
    for i, own in enumerate(queries.ids.tolist()):
        others = scores[i][ids != own]
        if len(others) >= best.k:
            best.floor[i] = max(best.floor[i], np.partition(others, len(others) - best.k)[len(others) - best.k])


def dual_search(queries: Tree, data: Tree, best: Best) -> int:
    """Walk both trees; the number of node pairs that were pruned comes back.

    Each query node holds the data nodes that may matter to it. The wider side goes down: data nodes
    wider than the query node give way to their children, else the query node hands its set on to its own.
    """
    if not len(queries.ids) or not len(data.ids):
        return 0
    _first_floors(queries, data, best)
    pruned = 0
    stack = [(0, np.array([0]))]
    while stack:
        q, xs = stack.pop()
        mine = slice(queries.begin[q], queries.end[q])
        top = bounds(queries, q, data, xs)
        stays = ~(top < best.floor[mine].min())
        pruned += int((~stays).sum())
        xs, top = xs[stays], top[stays]
        if not len(xs):
            continue
        inner = data.first[xs] < data.last[xs]
        q_leaf = queries.first[q] == queries.last[q]
        wide = inner & (q_leaf | (data.radius[xs] >= queries.radius[q]))
        if wide.any():
            stack.append((q, np.concatenate([xs[~wide], _spans(data.first[xs[wide]], data.last[xs[wide]])])))
        elif not q_leaf:
            stack += [(c, xs) for c in range(queries.first[q], queries.last[q])]
        else:
            order = np.argsort(-top)  # the best are taken first
            for part in np.array_split(order, max(1, len(order) // 512)):
                some = part[~(top[part] < best.floor[mine].min())]
                pruned += len(part) - len(some)
                if not len(some):
                    continue
                at = _spans(data.begin[xs[some]], data.end[xs[some]])
                scores, ids = products(queries.points[mine], data.points[at]), data.ids[at]
                best.scored += scores.size
                for i, row in enumerate(scores):
                    best.offer(int(mine.start) + i, int(queries.ids[mine.start + i]), ids, row)
    return pruned


def _quantised(vectors: pa.Array, scale: float) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat.reshape(len(vectors), -1) * scale) if len(vectors) else flat.reshape(0, 0)


def _write_pivots(batches: Iterator[pa.RecordBatch], folder: str, scale: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            held = io.BytesIO()
            np.save(held, np.unique(np.floor(np.array(row["pivots"], np.float64) * scale), axis=0))
            with new_file(row["path"]) as out:
                out.write(held.getvalue())
        yield batch.select(["path"])


def _deal(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    """The cell of each row becomes its nearest pivot's; rows of a cell stand together."""
    path, centres = None, None
    for batch in batches:
        parts, names = batch.column("_path").to_pylist(), batch.column("_cell").to_pylist()
        cuts = [0, *[i for i in range(1, len(parts)) if parts[i] != parts[i - 1]], len(parts)]
        for a, b in zip(cuts, cuts[1:]):
            if parts[a] != path:
                path = parts[a]
                with open_file(path) as stream:
                    centres = np.load(io.BytesIO(stream.read()))
            points = _quantised(batch.column("_vector").slice(a, b - a), scale)
            near = ((centres**2).sum(1) - 2 * points @ centres.T).argmin(1)
            names[a:b] = [f"{names[a]}.{n}" for n in near.tolist()]
        kept = [batch.column(c) for c in ("_vec", "_vector", "_dim")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(names, pa.string())], names=["_vec", "_vector", "_dim", "_cell"])


def _sized(rows: DataFrame, most: int) -> DataFrame:
    """Rows with ``_parts``, the number of blocks their cell needs, and ``_block``, one of them by a hash."""
    sizes = materialize(rows.groupBy("_dim", "_cell").count(), "cell_sizes").select(F.col("_dim").alias("_d"), F.col("_cell").alias("_c"), F.ceil(F.col("count") / most).alias("_parts"))
    placed = rows.join(sizes, (F.col("_dim") == F.col("_d")) & (F.col("_cell") == F.col("_c"))).drop("_d", "_c")
    return placed.withColumn("_block", F.pmod(F.xxhash64("_vec", "_vector"), F.col("_parts")).cast("int"))


def _cells(rows: DataFrame, folder: str, pivots: int, most: int, scale: float) -> DataFrame:
    """Rows with ``_cell``: dealt by pivots again and again while a cell has more than ``most`` rows and parts."""
    done, rows, before, turn = [], materialize(rows.withColumn("_cell", F.lit("0")), "cells"), 0, 0
    while True:
        cells = rows.groupBy("_dim", "_cell").count()
        found = cells.agg(F.max("count").alias("most"), F.count(F.lit(1)).alias("all"), F.count_if(F.col("count") > most).alias("large")).first()
        # As many cells as were dealt: each of them is copies of one vector, which pivots do not part.
        if found["most"] is None or found["most"] <= most or found["all"] == before:
            break
        before, turn = found["large"], turn + 1
        sized = materialize(_sized(rows, most), "sized_cells")
        done.append(sized.filter(F.col("_parts") <= 1).select(*rows.columns))
        large = sized.filter((F.col("_parts") > 1) & (F.col("_dim") > 0))
        done.append(sized.filter((F.col("_parts") > 1) & (F.col("_dim") == 0)).select(*rows.columns))
        path = F.concat(F.lit(f"{folder}/pivots-{turn}-"), F.col("_dim").cast("string"), F.lit("-"), F.col("_cell"), F.lit(".npy"))
        drawn = top_per_key(large, ["_dim", "_cell"], [F.xxhash64("_vec", "_vector"), F.col("_vec")], pivots, "_nth")
        lists = drawn.groupBy("_dim", "_cell").agg(F.collect_list("_vector").alias("pivots")).select(path.alias("path"), "pivots")
        materialize(lists.mapInArrow(partial(_write_pivots, folder=folder, scale=scale), "path string"), "pivots")
        keys = ["_dim", "_cell", "_block"]
        near = large.withColumn("_path", path).repartition(*keys).sortWithinPartitions(*keys)
        rows = materialize(near.mapInArrow(partial(_deal, scale=scale), "_vec long, _vector array<double>, _dim int, _cell string"), "cells")
    for part in done:
        rows = rows.unionByName(part)
    return materialize(rows, "cells") if done else rows


def _write_trees(batches: Iterator[pa.RecordBatch], folder: str, kind: str, scale: float) -> Iterator[pa.RecordBatch]:
    """Rows stand block by block; each block becomes a file, and a row that describes it."""
    key, held = None, []

    def done() -> pa.RecordBatch:
        dim, cell, block = key
        table = pa.Table.from_batches(held).combine_chunks()
        points = _quantised(table.column("_vector").combine_chunks(), scale).reshape(len(table), dim)
        tree = build_tree(table.column("_vec").to_numpy(), points)
        path = f"{folder}/{kind}-{dim}-{cell}-{block}.npz"
        tree.save(path)
        described = ((dim, pa.int32()), (cell, pa.string()), (block, pa.int32()), (path, pa.string()), (tree.centre[0].tolist(), pa.list_(pa.float64())), (float(tree.radius[0]), pa.float64()), (float(tree.norm[0]), pa.float64()))
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in described], names=["dim", "cell", "block", "path", "centre", "radius", "norm"])

    for batch in batches:
        keys = list(zip(*[batch.column(c).to_pylist() for c in ("_dim", "_cell", "_block")]))
        cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if keys[a] != key:
                if held:
                    yield done()
                key, held = keys[a], []
            held.append(batch.slice(a, b - a))
    if held:
        yield done()


def _blocks(rows: DataFrame, most: int, folder: str, kind: str, scale: float) -> DataFrame:
    """Write a tree for each cell, or for each block of about ``most`` rows of a larger one."""
    keys = ["_dim", "_cell", "_block"]
    grouped = _sized(rows, most).drop("_parts").repartition(*keys).sortWithinPartitions(*keys)
    return materialize(grouped.mapInArrow(partial(_write_trees, folder=folder, kind=kind, scale=scale), "dim int, cell string, block int, path string, centre array<double>, radius double, norm double"), f"{kind}_blocks")


def _search(batches: Iterator[pa.RecordBatch], k: int, home: bool) -> Iterator[pa.RecordBatch]:
    """Search pairs of blocks. At home the floors found are kept beside the queries' file, elsewhere they are read."""
    data_path = data = None
    held: OrderedDict[str, tuple[Tree, np.ndarray | None]] = OrderedDict()
    for batch in batches:
        for row in batch.to_pylist():
            if row["data_path"] != data_path:
                data_path, data = row["data_path"], load_tree(row["data_path"])
            query_path = row["query_path"]
            if query_path not in held:
                floor = None
                if not home:
                    with open_file(f"{query_path}.floor") as stream:
                        floor = np.load(io.BytesIO(stream.read()))
                held[query_path] = load_tree(query_path), floor
            held.move_to_end(query_path)
            if len(held) > 8:
                held.popitem(last=False)
            queries, floor = held[query_path]
            best = Best(queries, k, floor)
            dual_search(queries, data, best)
            if home:
                out = io.BytesIO()
                np.save(out, best.floor)
                with new_file(f"{query_path}.floor") as stream:
                    stream.write(out.getvalue())
            found = [(int(q), i, -s) for q, rows in zip(queries.ids, best.rows) for s, i in rows]
            columns = [pa.array([query_path] * len(found), pa.string()), *[pa.array([f[j] for f in found], pa.int64()) for j in range(3)], pa.array([int(best.floor.min())] * len(found), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["query_path", "query_id", "vec_id", "score", "low"])


_FOUND = "query_path string, query_id long, vec_id long, score long, low long"


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows that take part, as ``_vec``, ``_vector`` (doubles) and ``_dim``."""
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = df.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & F.coalesce(finite, F.lit(False)))
    return rows.select(F.col(id_col).cast("long").alias("_vec"), vector.alias("_vector"), F.size(vector_col).alias("_dim"))


def top_products(
    df: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, scale: float = SCALE,
    pivots: int = PIVOTS, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k best rows for every row that ``is_query`` picks by ``_vec``."""
    spark = df.sparkSession
    ship(spark)
    folder = scratch_path(spark, "cover_trees")
    make_folder(folder)
    rows = usable(df, id_col, vector_col)
    celled = _cells(rows, folder, pivots, block_rows, scale)
    data = _blocks(celled, block_rows, folder, "data", scale)
    queries = _blocks(celled.filter(is_query).dropDuplicates(["_vec", "_vector"]), query_rows, folder, "queries", scale)

    q = queries.select("dim", F.col("cell").alias("q_cell"), F.col("path").alias("query_path"), F.col("centre").alias("q_centre"), F.col("radius").alias("q_radius"), F.col("norm").alias("q_norm"))
    x = data.select(F.col("dim").alias("x_dim"), F.col("cell").alias("x_cell"), "block", F.col("path").alias("data_path"), F.col("centre").alias("x_centre"), F.col("radius").alias("x_radius"), F.col("norm").alias("x_norm"))
    fewest = x.groupBy(F.col("x_dim").alias("h_dim"), F.col("x_cell").alias("h_cell")).agg(F.min("block").alias("h_block"))
    home_blocks = materialize(x.join(fewest, (F.col("x_dim") == F.col("h_dim")) & (F.col("x_cell") == F.col("h_cell")) & (F.col("block") == F.col("h_block"))).select("x_dim", "x_cell", F.col("data_path").alias("home")), "home_blocks")
    with_home = materialize(q.join(home_blocks, (F.col("dim") == F.col("x_dim")) & (F.col("q_cell") == F.col("x_cell"))).drop("x_dim", "x_cell"), "query_homes")
    pairs = ["data_path", "query_path"]
    at_home = with_home.select(F.col("home").alias("data_path"), "query_path")
    # Numbers of their own: Spark would merge these few bytes into few tasks, but each row is a search.
    blocks = max(1, data.count())
    near = materialize(at_home.repartition(blocks, *pairs).sortWithinPartitions(*pairs).mapInArrow(partial(_search, k=k, home=True), _FOUND), "near_scores")
    # The least floor of a group; a group with a query that found too little at home has none.
    lows = near.groupBy(F.col("query_path").alias("w_path")).agg(F.min("low").alias("low"))
    bounded = with_home.join(lows, F.col("query_path") == F.col("w_path"), "left").withColumn("worst", F.coalesce("low", F.lit(LOWEST)))

    # Pairs of blocks meet by a shard number, so that descriptions of blocks are dealt over tasks.
    shards = max(1, blocks // 64)
    q_dealt = bounded.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    x_dealt = x.withColumn("x_shard", F.pmod(F.xxhash64("data_path"), F.lit(shards)).cast("int"))

    def norm(c: str) -> Column:
        return F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, v: s + v * v))

    dot = F.aggregate(F.zip_with("q_centre", "x_centre", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    own, theirs, radii = norm("q_centre"), norm("x_centre"), F.col("q_radius") + F.col("x_radius")
    slack = F.pow(own + theirs + radii, F.lit(2.0)) * 1e-9 + 1e-6
    by_centre = dot + own * F.col("x_radius") + theirs * F.col("q_radius") + F.col("q_radius") * F.col("x_radius")
    apart = F.greatest(F.sqrt(F.greatest(own * own + theirs * theirs - dot * 2 - slack, F.lit(0.0))) - radii, F.lit(0.0))
    by_distance = (F.col("q_norm") * F.col("q_norm") + F.col("x_norm") * F.col("x_norm") - apart * apart) / 2
    # Not-a-number is the greatest in Spark: least() drops it only where another bound is a number.
    most = F.least(by_centre, by_distance, F.col("q_norm") * F.col("x_norm")) + slack
    met = q_dealt.join(x_dealt, (F.col("shard") == F.col("x_shard")) & (F.col("dim") == F.col("x_dim")))
    rest = met.filter((F.col("data_path") != F.col("home")) & (most >= F.col("worst"))).select("data_path", "query_path")
    far = rest.repartition(blocks, *pairs).sortWithinPartitions(*pairs).mapInArrow(partial(_search, k=k, home=False), _FOUND)
    found = near.unionByName(far).select("query_id", "vec_id", "score")
    best = top_per_key(found, ["query_id"], [F.col("score").desc(), F.col("vec_id")], k, "rank")
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
