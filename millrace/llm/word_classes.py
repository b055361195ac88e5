"""Word classes by exchange: each word goes to the class where the text's likelihood grows most.

The likelihood of a class bigram model hangs on the class bigram counts alone: the sum of f over its
cells less the sums over its rows and columns, with f(x) = x log x. The most frequent words start as a class each,
and all others in one class behind these. The first round moves every word of that class into one of
the others; later rounds move words of even and odd numbers in turn, as neighbours that move at once
can undo each other's gain. Words are dealt to a fixed number of groups; in a round every group moves
its words one after another, on its own copy of the counts, and the groups' moves are put together
for the next round. The round with the greatest likelihood stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GROUPS = 8
ROUNDS = 5


def f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(table: np.ndarray) -> float:
    return float(f(table).sum() - f(table.sum(1)).sum() - f(table.sum(0)).sum())


def moved(table: np.ndarray, left: np.ndarray, right: np.ndarray, own: float, here: int, classes: int) -> tuple[np.ndarray, int]:
    """Counts and class of a word after its best move among the first ``classes``.

    ``left`` and ``right`` count the classes before and behind it, ``own`` how often it follows itself.
    """
    left, right = left.astype(float), right.astype(float)
    # Counts beside itself move along with the word.
    left[here] -= own
    right[here] -= own
    rest = table.copy()
    rest[here] -= right
    rest[:, here] -= left
    rest[here, here] -= own
    # Sums of each class but for the word's own row and column, which go to the class chosen.
    rows, columns = (rest.sum(1) + left)[:classes], (rest.sum(0) + right)[:classes]
    out, into = right.sum() + own, left.sum() + own
    diagonal = np.arange(classes)
    gain = np.zeros(classes)
    some = np.flatnonzero(right)
    gain += (f(rest[:classes][:, some] + right[some]) - f(rest[:classes][:, some])).sum(1)
    some = np.flatnonzero(left)
    gain += (f(rest[some][:, :classes] + left[some][:, None]) - f(rest[some][:, :classes])).sum(0)
    # A class's cell with itself gets both, and the word's own.
    cell, a, b = rest[diagonal, diagonal], left[:classes], right[:classes]
    gain += f(cell + a + b + own) - f(cell + a) - f(cell + b) + f(cell)
    gain -= f(rows + out) - f(rows) + f(columns + into) - f(columns)
    best = here if here < classes and gain[here] >= gain.max() - 1e-9 else int(gain.argmax())
    rest[best] += right
    rest[:, best] += left
    rest[best, best] += own
    return rest, best


def _round(table: pa.Table, counts: np.ndarray, of_item: np.ndarray, classes: int) -> pa.Table:
    item, side, klass, n = (table.column(c).to_numpy() for c in ("item", "side", "klass", "n"))
    order = np.argsort(item, kind="stable")
    item, side, klass, n = item[order], side[order], klass[order], n[order]
    words, first = np.unique(item, return_index=True)
    ends = np.append(first[1:], len(item))
    chosen = []
    size = len(counts)
    for word, a, b in zip(words.tolist(), first.tolist(), ends.tolist()):
        vectors = np.zeros((3, size))
        np.add.at(vectors, (side[a:b], klass[a:b]), n[a:b])
        own = vectors[2].sum()
        counts, best = moved(counts, vectors[0], vectors[1], own, int(of_item[word]), classes)
        chosen.append(best)
    return pa.table({"item": pa.array(words, pa.int32()), "klass": pa.array(chosen, pa.int32())})


def _with_classes(pairs: DataFrame, of_item: np.ndarray) -> DataFrame:
    """``pairs`` with the classes ``before`` and ``behind``; one broadcast row per item."""
    table = pa.table({"item": np.arange(len(of_item), dtype=np.int32), "klass": of_item.astype(np.int32)})
    known = F.broadcast(pairs.sparkSession.createDataFrame(table))
    for item, klass in (("first", "before"), ("second", "behind")):
        pairs = pairs.join(known.select(F.col("item").alias(item), F.col("klass").alias(klass)), item)
    return pairs


def exchange(pairs: DataFrame, movable: int, classes: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Class of each item and the class bigram counts.

    ``pairs`` (stored): (first int, second int, n long) over items: ``movable`` words, the most frequent
    first, then all other words as one, then ends. The last two keep the classes ``classes + 1`` and
    ``classes``. Items and classes are of bounded number.
    """
    size = classes + 2
    start = np.arange(movable)
    of_item = np.concatenate([np.where(start < classes, start, classes + 1), [classes + 1, classes]])
    best: tuple[float, np.ndarray, np.ndarray] | None = None
    idle = 0
    for turn in range(rounds + 1):
        joined = _with_classes(pairs, of_item)
        counts = np.zeros((size, size))
        for r in joined.groupBy("before", "behind").agg(F.sum("n").alias("n")).collect():  # classes squared
            counts[r["before"], r["behind"]] = r["n"]
        reached = likelihood(counts)
        # Words that have no class yet get one whatever it costs.
        if turn <= 1 or reached > best[0]:
            best, idle = (reached, of_item, counts), 0
        else:
            idle += 1
            of_item, counts = best[1:]
        if turn == rounds or idle == 2 or movable == 0:
            break
        moving = F.col("item") < movable
        moving &= F.col("item") >= classes if turn == 0 else F.col("item") % 2 == turn % 2
        if idle:
            joined = _with_classes(pairs, of_item)
        sides = F.explode(
            F.array(
                F.struct(F.col("second").alias("item"), F.lit(0).alias("side"), F.col("before").alias("klass")),
                F.struct(F.col("first").alias("item"), F.lit(1).alias("side"), F.col("behind").alias("klass")),
                F.struct(F.when(F.col("first") == F.col("second"), F.col("first")).alias("item"), F.lit(2).alias("side"), F.col("before").alias("klass")),
            )
        ).alias("s")
        vectors = joined.select(sides, "n").select("s.*", "n").filter(moving)
        vectors = vectors.groupBy("item", "side", "klass").agg(F.sum("n").alias("n"))
        grouped = vectors.withColumn("part", F.pmod(F.xxhash64("item"), F.lit(GROUPS))).groupBy("part")

        def work(table: pa.Table) -> pa.Table:
            return _round(table, counts, of_item, classes)

        moves = grouped.applyInArrow(work, "item int, klass int").collect()  # a row per item
        of_item = of_item.copy()
        for r in moves:
            of_item[r["item"]] = r["klass"]
    return best[1], best[2]


def nearest(left: np.ndarray, right: np.ndarray, counts: np.ndarray, classes: int) -> np.ndarray:
    """The best class of words that are rare against every class: the same gain to first order, for a row of counts each."""
    out, into = counts.sum(1)[:classes], counts.sum(0)[:classes]
    usable = (out > 0) & (into > 0)
    if not usable.any():
        return np.zeros(len(left), np.int64)
    floor = 0.5
    gain = right @ np.log(np.maximum(counts[:classes], floor)).T + left @ np.log(np.maximum(counts[:, :classes], floor))
    gain -= left.sum(1)[:, None] * (np.log(np.maximum(out, floor)) + np.log(np.maximum(into, floor)))
    return np.where(usable, np.round(gain, 6), -np.inf).argmax(1)


def rows_by_word(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[list[str], np.ndarray]]:
    """(words, summed counts) from rows (word, vector) sorted by word; only the last word waits for the next batch.

    A vector is a run of (key byte, count in 4 bytes).
    """
    held: tuple[str, np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        coded = batch.column("word").dictionary_encode()
        of_row, words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
        vectors = batch.column("vector")
        _, offsets, data = vectors.cast(pa.binary()).buffers()
        at = np.frombuffer(offsets, np.int32)[vectors.offset : vectors.offset + len(vectors) + 1]
        cells = np.frombuffer(data, ENTRY, (at[-1] - at[0]) // ENTRY.itemsize, int(at[0]))
        row = np.repeat(of_row.astype(np.int64), np.diff(at) // ENTRY.itemsize)
        sums = np.bincount(row * width + cells["key"], cells["n"], len(words) * width).reshape(-1, width)
        if held is not None:
            if held[0] == words[0]:
                sums[0] += held[1]
            else:
                yield [held[0]], held[1][None]
        if len(words) > 1:
            yield words[:-1], sums[:-1]
        held = (words[-1], sums[-1])
    if held is not None:
        yield [held[0]], held[1][None]


ENTRY = np.dtype([("key", "u1"), ("n", "<u4")])
