"""Largest inner products of blocks of queries with blocks of vectors that lie in shared files, by falling norm."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from millrace.ml.block_als import read_file, write_file

_ROWS = 256


def writer(folder: str) -> Callable:
    """A file per row ``(_other, _others, _theirs)``: the block's ids and then its vectors."""

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.column("_other")[i].as_py()
                ids, vectors = (batch.column(c)[i].values.to_numpy() for c in ("_others", "_theirs"))
                write_file(f"{folder}/{block}", ids.astype("int64").tobytes() + vectors.astype("float64").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64())], names=["block"])

    return write


class _Best:
    """The best ``k`` of each query so far, and its floor: no row below it can be among them."""

    def __init__(self, vectors, floors, k: int):
        import numpy as np

        self.own, self.small, self.floors, self.k = vectors, vectors.astype(np.float32), floors.copy(), k
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.held, self.best = np.full((len(vectors), k), -1, np.int64), np.full((len(vectors), k), -np.inf)
        # What products in single precision can be off, as a share of both norms.
        self.rounding = (vectors.shape[1] + 8) * float(np.finfo(np.float32).eps)

    def open(self, reach: float):
        """Queries for which a vector of norm ``reach`` can be among the best."""
        import numpy as np

        return np.flatnonzero((self.floors <= 0) | (self.norms * (reach * (1 + 1e-9)) >= self.floors))

    def meet(self, queries, others, theirs, reach: float) -> None:
        import numpy as np

        across = np.ascontiguousarray(theirs.T, np.float32)
        for at in range(0, len(queries), _ROWS):
            some = queries[at : at + _ROWS]
            rough = self.small[some] @ across
            margin = self.rounding * self.norms[some] * reach
            cut = self.floors[some] - margin
            if rough.shape[1] > self.k and np.isneginf(cut).any():
                cut = np.maximum(cut, np.partition(rough, -self.k, axis=1)[:, -self.k] - 2 * margin)
            hit = np.flatnonzero(rough.max(axis=1) >= cut)
            if len(hit):
                row, col = np.nonzero(rough[hit] >= cut[hit, None])
                self._add(some[hit[row]], others[col], theirs[col])

    def _add(self, row, other, theirs) -> None:
        import numpy as np

        # Added up one factor after another, so that a score does not depend on the blocks.
        score = np.zeros(len(row))
        for f in range(theirs.shape[1]):
            score += self.own[row, f] * theirs[:, f]
        known = score >= self.floors[row]
        row, other, score = row[known], other[known], score[known]
        if not len(row):
            return
        met = np.unique(row)
        old, place = np.nonzero(self.held[met] >= 0)
        old = met[old]
        row, other, score = np.concatenate([old, row]), np.concatenate([self.held[old, place], other]), np.concatenate([self.best[old, place], score])
        order = np.lexsort((other, -score, row))
        row, other, score = row[order], other[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        row, other, score, place = (v[place < self.k] for v in (row, other, score, place))
        self.held[row, place], self.best[row, place] = other, score
        last = place == self.k - 1
        self.floors[row[last]] = np.maximum(self.floors[row[last]], score[last])


def searcher(folder: str, reach: Sequence[float], shares: int, k: int) -> Callable:
    """Best ``k`` rows, none below a query's floor, for query blocks ``(_share, _ids, _vectors, _floors)`` in the data blocks of their share.

    ``reach``: the largest norm in data block 1, 2, ... A block is read only if a query is still open for it, and met by those queries.
    """

    def search(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                share = batch.column("_share")[i].as_py()
                ids, vectors, floors = (batch.column(c)[i].values.to_numpy() for c in ("_ids", "_vectors", "_floors"))
                best = _Best(vectors.reshape(len(ids), -1), floors, k)
                for block in range(1 + share, len(reach) + 1, shares):
                    queries = best.open(reach[block - 1])
                    if not len(queries):
                        break
                    data = read_file(f"{folder}/{block}")
                    n = len(data) // (8 + 8 * best.own.shape[1])
                    theirs = np.frombuffer(data, np.float64, offset=8 * n).reshape(n, -1)
                    best.meet(queries, np.frombuffer(data, np.int64, n), theirs, reach[block - 1])
                row, place = np.nonzero(best.held >= 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row], pa.int32()), pa.array(best.held[row, place].astype(np.int32)), pa.array(best.best[row, place])], names=["id", "other", "score"]
                )

    return search
