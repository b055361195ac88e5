"""Best-fit packing by minimum bin slack.

Texts become token ids, each closed by an end id; only those longer than a sequence are cut. The
packing is planned on the histogram of piece lengths, at most one count per possible length, so
the plan is as small for any number of documents: take the longest length left, and find by subset
sums, held in the bits of one integer, the fullest combination of the lengths left that goes with
it. That combination is taken out as often as the counts allow, and so on. Pieces then find their
place in the plan by their rank among pieces of equal length: the task that cuts them numbers its own
per length, and the sums over the tasks before it, at most one number per task and length, are files
that a second pass over the stored pieces reads. No piece is shuffled, however often it is repeated.

Defined results: a null or empty text is its end id alone. Rows equal in id and text are packed
each on its own. An empty table gives an empty table. All other columns are kept (also when
``keep`` is given, in that order), but for those with the name of a result, which it replaces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared_files import make_folder, new_file, open_file
from millrace.llm.support import BATCH_BYTES, extended, kept_columns, large_batches, map_arrow, set_aside, ship, small_batches
from millrace.llm.token_ids import MOST_CACHED, encode
from millrace.storage import materialize, scratch_path

SEQUENCE = 2048
PIECE_COLUMNS = "piece int, start long, length long, ids_crc32 long"
RESULTS = ("piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset", "_part", "_nth")
NUMBERED = "_part int, _nth long"


class Numbers:
    """Numbers a task's pieces from 0 among those of equal length."""

    def __init__(self) -> None:
        self.part = TaskContext.get().partitionId()
        self.seen = np.zeros(0, np.int64)

    def columns(self, length: np.ndarray) -> list[pa.Array]:
        here = np.bincount(length, minlength=len(self.seen))
        self.seen = np.pad(self.seen, (0, len(here) - len(self.seen)))
        order = np.argsort(length, kind="stable")
        nth = np.empty(len(length), np.int64)
        nth[order] = np.arange(len(length)) - (np.cumsum(here) - here)[length[order]]
        nth += self.seen[length]
        self.seen += here
        return [pa.array(np.full(len(length), self.part, np.int32)), pa.array(nth)]


def _cut(batches: Iterator[pa.RecordBatch], path: str, text_col: str, keep: list[str], most: int, with_ids: bool, most_cached: int = MOST_CACHED, batch_bytes: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    numbers = Numbers()
    for whole in large_batches(batches, text_col, batch_bytes):
        for batch in small_batches(whole, text_col, batch_bytes):
            ids, at = encode(batch.column(text_col), path, spaces_matter=False, most_cached=most_cached)
            counts = -(-np.diff(at) // most)
            doc = np.repeat(np.arange(batch.num_rows), counts)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
            start = piece * most
            length = np.minimum(np.diff(at)[doc] - start, most)
            first = at[:-1][doc] + start
            little = ids.astype("<u4")
            sums = [zlib.crc32(little[a : a + n]) for a, n in zip(first.tolist(), length.tolist())]
            columns = batch.select(keep).take(pa.array(doc, pa.int32())).columns if keep else []
            columns += [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(sums, pa.int64())]
            names = [*keep, "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.append(first, at[-1]), pa.int32()), pa.array(ids.astype(np.int32))))
                names.append("ids")
            columns += numbers.columns(length)
            names += ["_part", "_nth"]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def cut_pieces(df: DataFrame, path: str, text_col: str = "text", keep: list[str] | None = None, most: int = SEQUENCE, with_ids: bool = True, most_cached: int = MOST_CACHED, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Pieces of at most ``most`` tokens of every text, with their ids if asked for; ``most_cached`` words are kept per task
    and each distinct word of ``batch_bytes`` of text is looked up once.

    ``_part`` and ``_nth`` number them for :func:`pack`, which drops both.
    """
    ship(df.sparkSession)
    keep = kept_columns(df, keep, RESULTS)
    schema = extended(df.select(*[f"`{c}`" for c in keep]).schema, PIECE_COLUMNS + (", ids array<int>, " if with_ids else ", ") + NUMBERED)
    needed = df.select(*[f"`{c}`" for c in dict.fromkeys([*keep, text_col])])
    return map_arrow(needed, partial(_cut, path=path, text_col=text_col, keep=keep, most=most, with_ids=with_ids, most_cached=most_cached, batch_bytes=batch_bytes), schema)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of available lengths with the largest sum up to ``room``; longer lengths first."""
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((n for n, c in counts.items() if c and n <= room), reverse=True):
        left, copies = min(counts[length], room // length), 1
        while left:
            copies = min(copies, left)
            steps.append((reach, length, copies))
            reach |= (reach << (length * copies)) & mask
            left -= copies
            copies *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for before, length, copies in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + copies
            total -= length * copies
    return chosen


def plan(counts: dict[int, int], size: int = SEQUENCE) -> list[tuple[dict[int, int], int]]:
    """(combination, how many sequences hold it), until no length is left."""
    left, out = dict(counts), []
    for longest in sorted(left, reverse=True):
        while left[longest]:
            left[longest] -= 1
            chosen = fullest(left, size - longest)
            left[longest] += 1
            chosen[longest] = chosen.get(longest, 0) + 1
            times = min(left[n] // k for n, k in chosen.items())
            for n, k in chosen.items():
                left[n] -= k * times
            out.append((chosen, times))
    return out


def slots(planned: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, pieces per sequence, offset of the first), sorted."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for chosen, times in planned:
        offset = 0
        for n in sorted(chosen, reverse=True):
            rows.append((n, used.get(n, 0), sequence, chosen[n], offset))
            used[n] = used.get(n, 0) + chosen[n] * times
            offset += n * chosen[n]
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _place(batches: Iterator[pa.RecordBatch], table: np.ndarray, folder: str) -> Iterator[pa.RecordBatch]:
    lengths, at = np.unique(table[:, 0], return_index=True)
    bounds = dict(zip(lengths.tolist(), zip(at.tolist(), [*at[1:].tolist(), len(table)])))
    before = (None, None)
    for batch in batches:
        length, part = batch.column("length").to_numpy(), batch.column("_part").to_numpy()
        rank = batch.column("_nth").to_numpy().copy()
        for p in np.unique(part).tolist():
            if before[0] != p:
                before = p, _read_before(f"{folder}/{p}")
            mine = part == p
            rank[mine] += before[1][length[mine]]
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for n in np.unique(length).tolist():
            at = np.flatnonzero(length == n)
            lo, hi = bounds[n]
            row = table[lo + np.searchsorted(table[lo:hi, 1], rank[at], side="right") - 1]
            nth, within = np.divmod(rank[at] - row[:, 1], row[:, 3])
            sequence[at] = row[:, 2] + nth
            offset[at] = row[:, 4] + within * n
        names = [c for c in batch.schema.names if c not in ("_part", "_nth")]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])


def _read_before(path: str) -> np.ndarray:
    with open_file(path) as stream:
        pairs = np.frombuffer(stream.read(), "<i8").reshape(-1, 2)
    out = np.zeros(int(pairs[:, 0].max()) + 1, np.int64)
    out[pairs[:, 0]] = pairs[:, 1]
    return out


def _write_before(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """A file of (length, pieces in the parts before) per part, from rows sorted by part."""
    held: tuple[int, list[np.ndarray]] | None = None

    def done() -> pa.RecordBatch:
        with new_file(f"{folder}/{held[0]}") as out:
            out.write(np.concatenate(held[1]).astype("<i8").tobytes())
        return pa.RecordBatch.from_arrays([pa.array([held[0]], pa.int32())], names=["_part"])

    for batch in batches:
        part = batch.column("_part").to_numpy()
        pairs = np.column_stack([batch.column("length").to_numpy(), batch.column("_before").to_numpy()])
        for p in np.unique(part).tolist():
            if held is not None and held[0] != p:
                yield done()
                held = None
            held = held or (p, [])
            held[1].append(pairs[part == p])
    if held is not None:
        yield done()


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers = Numbers()
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns, *numbers.columns(batch.column("length").to_numpy())], names=[*batch.schema.names, "_part", "_nth"])


def pack(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """``pieces`` (with ``length`` from 1 to ``size``) with ``sequence_id`` and gapless ``offset``."""
    ship(pieces.sparkSession)
    pieces = set_aside(pieces, "sequence_id", "offset")
    stored = materialize(pieces, "pieces")
    per_part = ["_part", "length"]
    if "_nth" in stored.columns:
        sizes = materialize(stored.groupBy(*per_part).agg(F.count("*").alias("n"), F.max("_nth").alias("last")), "piece_counts")
    if "_nth" not in stored.columns or sizes.filter("n <> last + 1").limit(1).count():
        # Not all pieces that were cut together are here: they are numbered anew.
        stored = set_aside(stored, "_part", "_nth")
        stored = materialize(map_arrow(stored, _number, extended(stored.schema, NUMBERED)), "pieces")
        sizes = materialize(stored.groupBy(*per_part).agg(F.count("*").alias("n")), "piece_counts")
    # At most one row per possible length.
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    folder = scratch_path(pieces.sparkSession, "pieces_before")
    make_folder(folder)
    # A length has a row per task.
    earlier = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(*per_part, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    materialize(before.repartition("_part").sortWithinPartitions("_part").mapInArrow(partial(_write_before, folder=folder), "_part int"), "parts")
    schema = extended(stored.drop("_part", "_nth").schema, "sequence_id long, offset long")
    return map_arrow(stored, partial(_place, table=slots(plan(counts, size)), folder=folder), schema)
