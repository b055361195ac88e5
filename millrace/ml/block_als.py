"""Alternating least squares over blocks of ratings kept in shared files.

The library's ALS holds a block of ratings in the memory of one task, about 60 bytes a rating while it is built, and
sends each factor to every block that has one of its ratings: fewer blocks do not fit into memory, more fill the disks
with shuffles. Here a block is a file of 12 bytes a rating, dealt by id modulo the number of blocks as the library
does, and so are the vectors of a block. A half step has one task per block: it reads its ratings, meets the files of
the other side one after another, and writes its new vectors. Nothing is shuffled, a task holds one block's ratings
and their vectors, and only the newest vectors are kept. All ratings of one id are in one block, also as there.
"""

from __future__ import annotations

import io
import math
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.storage import materialize, scratch_path, ship_package

#: Ratings per block; while it solves, a task holds about ``12 + 4 * rank`` bytes for each.
BLOCK_ROWS = 2_000_000
_SLICE = 1 << 17


def _located(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def write_file(path: str, data) -> None:
    """A whole file under its name, also if the task runs twice."""
    system, inner = _located(path)
    folder, _, name = inner.rpartition("/")
    system.create_dir(folder, recursive=True)
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(draft, compression=None) as out:
        out.write(data)
    system.move(draft, inner)


def read_file(path: str) -> bytes:
    system, inner = _located(path)
    with system.open_input_stream(inner, compression=None) as file:
        return file.read()


def drop_folder(path: str) -> None:
    from pyarrow import fs

    system, inner = _located(path)
    if system.get_file_info(inner).type != fs.FileType.NotFound:
        system.delete_dir(inner)


def _vectors(folder: str, block: int, rank: int):
    import numpy as np

    return np.frombuffer(read_file(f"{folder}/{block}"), np.float32).reshape(-1, rank)


def _by_block(ids, blocks: int):
    """(places in order of their block, where each block begins)."""
    import numpy as np

    block = ids % blocks
    order = np.argsort(block, kind="stable")
    return order, np.searchsorted(block[order], np.arange(blocks + 1))


def _block_ids(batches: Iterator) -> Iterator[int]:
    for batch in batches:
        yield from batch.column(0).to_pylist()


def _done(block: int):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64())], names=["id"])


def _packer(folder: str, blocks: int, ids: int) -> Callable:
    """Writes the ratings of one block: ``rating`` in order of id, and where the other side's vectors go."""

    def pack(key, table):
        import numpy as np
        import pyarrow as pa

        block = key[0].as_py()
        own, other, rating = (table[c].to_numpy() for c in ("own", "other", "rating"))
        if table["rating"].null_count or np.isnan(rating).any():
            raise ValueError("a rating is null or NaN")
        # By all columns, so that sums do not depend on the order in which rows arrive.
        order = np.lexsort((rating, other, own))
        own, other, rating = own[order] // blocks, other[order], rating[order]
        places, starts = _by_block(other, blocks)
        counts = np.bincount(own, minlength=len(range(block, ids, blocks)))
        out = io.BytesIO()
        np.savez(out, rating=rating.astype(np.float32), counts=counts, starts=starts, places=places.astype(np.int32), rows=(other[places] // blocks).astype(np.int32))
        write_file(f"{folder}/{block}", out.getbuffer())
        return pa.table({"block": pa.array([block], pa.int32()), "n": pa.array([len(own)], pa.int64())})

    return pack


def _starter(folder: str, blocks: int, ids: int, rank: int, seed: int) -> Callable:
    """Random vectors of length 1."""

    def start(batches: Iterator) -> Iterator:
        import numpy as np

        for block in _block_ids(batches):
            v = np.random.default_rng([seed, block]).standard_normal((len(range(block, ids, blocks)), rank))
            v /= np.sqrt((v * v).sum(axis=1, keepdims=True))
            write_file(f"{folder}/{block}", v.astype(np.float32).tobytes())
            yield _done(block)

    return start


def normal_solutions(vectors, ratings, counts, reg: float):
    """The least squares solution of each id: ``counts`` of its rows follow one another; none is zero."""
    import numpy as np

    rank = vectors.shape[1]
    ends = np.cumsum(counts)
    starts = ends - counts
    out = np.empty((len(counts), rank), np.float32)
    lo = 0
    while lo < len(counts):
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + _SLICE)) - 1)
        gram, right = np.zeros((hi - lo, rank, rank)), np.zeros((hi - lo, rank))
        if hi == lo + 1:
            for at in range(starts[lo], ends[lo], _SLICE):
                part = vectors[at : min(at + _SLICE, ends[lo])].astype(np.float64)
                gram[0] += part.T @ part
                right[0] += part.T @ ratings[at : at + len(part)]
        else:
            at, to = starts[lo], ends[hi - 1]
            part, given, begins = vectors[at:to].T.astype(np.float64, order="C"), ratings[at:to].astype(np.float64), starts[lo:hi] - at
            for i in range(rank):
                right[:, i] = np.add.reduceat(part[i] * given, begins)
                for j in range(i + 1):
                    gram[:, i, j] = gram[:, j, i] = np.add.reduceat(part[i] * part[j], begins)
        gram[:, range(rank), range(rank)] += (reg * counts[lo:hi])[:, None]
        try:
            out[lo:hi] = np.linalg.solve(gram, right[:, :, None])[:, :, 0]
        except np.linalg.LinAlgError:
            out[lo:hi] = (np.linalg.pinv(gram, hermitian=True) @ right[:, :, None])[:, :, 0]
        lo = hi
    return out


def _solver(data: str, source: str, target: str, blocks: int, rank: int, reg: float) -> Callable:
    """New vectors of a block; NaN for ids without ratings."""

    def solve(batches: Iterator) -> Iterator:
        import numpy as np

        for block in _block_ids(batches):
            held = np.load(io.BytesIO(read_file(f"{data}/{block}")))
            places, rows, starts, counts = (held[c] for c in ("places", "rows", "starts", "counts"))
            met = np.empty((len(places), rank), np.float32)
            for other in range(blocks):
                at, to = starts[other], starts[other + 1]
                if to > at:
                    met[places[at:to]] = _vectors(source, other, rank)[rows[at:to]]
            known = np.flatnonzero(counts)
            out = np.full((len(counts), rank), np.nan, np.float32)
            out[known] = normal_solutions(met, held["rating"], counts[known], reg)
            write_file(f"{target}/{block}", out.tobytes())
            yield _done(block)

    return solve


def _lister(folder: str, blocks: int, rank: int) -> Callable:
    def listed(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for block in _block_ids(batches):
            v = _vectors(folder, block, rank)
            known = np.flatnonzero(~np.isnan(v[:, 0]))
            for at in range(0, len(known), 10_000):
                part = known[at : at + 10_000]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * rank), pa.array(v[part].ravel()))
                yield pa.RecordBatch.from_arrays([pa.array((part * blocks + block).astype(np.int32)), lists], names=["id", "features"])

    return listed


def _scorer(users: str, items: str, blocks: int, sizes: tuple[int, int], rank: int, drop: bool, rows: int = 1 << 20) -> Callable:
    """Predictions for the rows of a partition, about ``rows`` at a time; NaN, or no row, for ids without a vector."""

    def score(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def ids(table, column, size):
            v = pc.fill_null(table[column].cast(pa.int64()), -1).to_numpy()
            return np.where((v >= 0) & (v < size), v, -1)

        def each(ids, folder):
            known = np.flatnonzero(ids >= 0)
            order, starts = _by_block(ids[known], blocks)
            for block in np.flatnonzero(np.diff(starts)):
                at = known[order[starts[block] : starts[block + 1]]]
                yield at, _vectors(folder, block, rank)[ids[at] // blocks]

        def scored(held):
            table = pa.Table.from_batches(held)
            mine, out = np.full((len(table), rank), np.nan, np.float32), np.full(len(table), np.nan, np.float32)
            for at, v in each(ids(table, "user_id", sizes[0]), users):
                mine[at] = v
            for at, v in each(ids(table, "item_id", sizes[1]), items):
                out[at] = (mine[at] * v).sum(axis=1)
            table = table.append_column("prediction", pa.array(out, from_pandas=False))
            return (table.filter(pa.array(~np.isnan(out))) if drop else table).to_batches(10_000)

        held, n = [], 0
        for batch in batches:
            held, n = [*held, batch], n + batch.num_rows
            if n >= rows:
                yield from scored(held)
                held, n = [], 0
        if n:
            yield from scored(held)

    return score


class FactorModel:
    """What a fit found, with the members of the library's model that are used here."""

    def __init__(self, spark: SparkSession, folders: dict[str, str], blocks: int, sizes: dict[str, int], rank: int, cold: str):
        self.rank, self._spark, self._folders, self._blocks, self._sizes, self._cold = rank, spark, folders, blocks, sizes, cold
        self._listed: dict[str, DataFrame] = {}

    def _factors(self, side: str) -> DataFrame:
        if side not in self._listed:
            read = _lister(self._folders[side], self._blocks, self.rank)
            self._listed[side] = materialize(self._spark.range(0, self._blocks, 1, self._blocks).mapInArrow(read, "id int, features array<float>"), "factors")
        return self._listed[side]

    @property
    def userFactors(self) -> DataFrame:
        return self._factors("user_id")

    @property
    def itemFactors(self) -> DataFrame:
        return self._factors("item_id")

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` with a ``prediction``; where rows lie does not matter, nothing is joined."""
        sizes = self._sizes["user_id"], self._sizes["item_id"]
        score = _scorer(self._folders["user_id"], self._folders["item_id"], self._blocks, sizes, self.rank, self._cold == "drop")
        return rows.mapInArrow(score, rows.limit(0).withColumn("prediction", F.lit(0.0).cast("float")).schema)

    def release(self) -> None:
        """Removes the vectors' files; tables that were read from them stay."""
        for folder in self._folders.values():
            drop_folder(folder)


class Blocks:
    """Ratings (``user_id``, ``item_id`` int from 0 on, ``rating``) in blocks by user and by item, for any number of fits."""

    def __init__(self, ratings: DataFrame, block_rows: int = BLOCK_ROWS):
        self._spark = ratings.sparkSession
        ship_package(self._spark)
        n, users, items = ratings.agg(F.count(F.lit(1)), F.max("user_id") + 1, F.max("item_id") + 1).first()
        self._sizes = {"user_id": users, "item_id": items}
        self._blocks = max(self._spark.sparkContext.defaultParallelism, math.ceil(n / block_rows))
        self._root = scratch_path(self._spark, "als_blocks")
        for own, other in (("user_id", "item_id"), ("item_id", "user_id")):
            rows = ratings.select((F.col(own) % self._blocks).cast("int").alias("_block"), F.col(own).alias("own"), F.col(other).alias("other"), F.col("rating").cast("float").alias("rating"))
            pack = _packer(f"{self._root}/{own}", self._blocks, self._sizes[own])
            packed = materialize(rows.groupBy("_block").applyInArrow(pack, "block int, n bigint"), "als_packed")
            # A block without any rating is a file too.
            for block in set(range(self._blocks)) - {r["block"] for r in packed.select("block").collect()}:
                self._empty(own, block)

    def _empty(self, own: str, block: int) -> None:
        import pyarrow as pa

        columns = pa.table({"own": pa.array([], pa.int32()), "other": pa.array([], pa.int32()), "rating": pa.array([], pa.float32())})
        _packer(f"{self._root}/{own}", self._blocks, self._sizes[own])((pa.scalar(block),), columns)

    def _run(self, work: Callable) -> None:
        self._spark.range(0, self._blocks, 1, self._blocks).mapInArrow(work, "id bigint").write.format("noop").mode("overwrite").save()

    def fit(self, rank: int, iterations: int, reg: float, seed: int = 1, cold: str = "drop") -> FactorModel:
        """Items are solved for first, from random users, as the library does; ``reg`` is scaled by an id's ratings."""
        root = scratch_path(self._spark, "als_vectors")
        now = {"user_id": f"{root}/user_id-0"}
        self._run(_starter(now["user_id"], self._blocks, self._sizes["user_id"], rank, seed))
        for i in range(1, iterations + 1):
            for own, other in (("item_id", "user_id"), ("user_id", "item_id")):
                old, target = now.get(own), f"{root}/{own}-{i}"
                self._run(_solver(f"{self._root}/{own}", now[other], target, self._blocks, rank, reg))
                now[own] = target
                if old:
                    drop_folder(old)
        return FactorModel(self._spark, now, self._blocks, self._sizes, rank, cold)

    def release(self) -> None:
        drop_folder(self._root)
