"""Line dedup: repeated runs of lines found with a suffix array over line numbers.

Lines with at least one word are numbered, equal lines alike; lines found once end every run and
drop out. The suffixes of all documents' number sequences are then sorted by distributed prefix
doubling: ranks of 2, 4, 8, ... lines come from the pair of ranks of their halves. A run counts
from ``min_words`` words on, and every line has a word, so no suffix has to be sorted deeper than
``min_words`` lines, and only those that need it are: the doubling takes at most
log2(``min_words``) rounds, on fewer rows each.

In the sorted array, suffixes with a longest common prefix of at least the shortest sufficient run
stand together: an interval. Its first member in document order is the original, the others are
later copies. Shortest sufficient runs are taken from each starting line and to each ending line;
together they cover every maximal repeated run exactly. The lines of later copies are deleted.

Order of documents: by id (nulls last), then by a hash of the text. Copies may overlap within one
document. Defined results: a null text stays null, an empty one empty; blank lines stay; rows
equal in id and text are one document and get the same text. An empty table gives an empty table.
All other columns are kept; ``n_deleted_lines`` is added, and replaces an input column of its name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.sorted_groups import number_groups
from millrace.llm.support import doc_key, extended, set_aside, ship
from millrace.llm.textcodes import SPACES
from millrace.storage import materialize

MIN_WORDS = 50
RESULT = "n_deleted_lines"
_KEY = ("_k1", "_k2")


def _numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per line with a word: its place among them, its words, and 128 bits of its hash."""
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            rows = batch.slice(start, 256)
            source, place, count, digests = [], [], [], []
            for i, text in enumerate(rows.column("_text").to_pylist()):
                seq = 0
                for line in text.split(b"\n") if text else ():
                    n = len(line.split())
                    if n:
                        source.append(i)
                        place.append(seq)
                        count.append(n)
                        digests.append(hashlib.md5(line, usedforsecurity=False).digest())
                        seq += 1
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            keys = rows.select(["_id", *_KEY]).take(pa.array(source, pa.int32()))
            extra = [pa.array(place, pa.int32()), pa.array(count, pa.int32()), pa.array(halves[:, 0]), pa.array(halves[:, 1])]
            yield pa.RecordBatch.from_arrays([*keys.columns, *extra], names=["_id", *_KEY, "_seq", "_words", "_a", "_b"])


def runs_of(seqs: np.ndarray, words: np.ndarray, min_words: int) -> list[tuple[int, int]]:
    """(start, lines) of every shortest run with ``min_words`` words, from each start and to each end.

    Only lines with neighbouring numbers belong together; positions are those in ``seqs``.
    """
    found: set[tuple[int, int]] = set()
    breaks = np.flatnonzero(np.diff(seqs) != 1) + 1
    for lo, hi in zip([0, *breaks.tolist()], [*breaks.tolist(), len(seqs)]):
        total = np.concatenate(([0], np.cumsum(words[lo:hi])))
        ends = np.searchsorted(total, total[:-1] + min_words)
        found.update((lo + s, int(e) - s) for s, e in enumerate(ends.tolist()) if e < len(total))
        starts = np.searchsorted(total, total[1:] - min_words, side="right") - 1
        found.update((lo + s, e + 1 - s) for e, s in enumerate(starts.tolist()) if s >= 0)
    return sorted(found)


def _depths(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """Per document's repeated lines: the runs to look up, and how deep each line must be ranked."""
    for batch in batches:
        rows: list[tuple] = []
        for i, lines in enumerate(batch.column("_lines").to_pylist()):
            lines.sort(key=lambda x: x["_seq"])
            seqs = np.array([x["_seq"] for x in lines])
            runs = runs_of(seqs, np.array([x["_words"] for x in lines]), min_words)
            need, own = np.full(len(seqs), -1), {}
            for start, n in runs:
                level = n.bit_length() - 1
                need[start] = max(need[start], level)
                need[start + n - (1 << level)] = max(need[start + n - (1 << level)], level)
                own.setdefault(start, []).append(n)
            for level in range(need.max(initial=-1), 0, -1):
                for at in np.flatnonzero(need >= level).tolist():
                    half = at + (1 << (level - 1))
                    need[half] = max(need[half], level - 1)
            rows += [(i, int(seqs[at]), lines[at]["group"], int(need[at]), own.get(at, [])) for at in np.flatnonzero(need >= 0).tolist()]
        source = pa.array([r[0] for r in rows], pa.int32())
        keys = batch.select(["_id", *_KEY]).take(source)
        extra = [pa.array([r[k] for r in rows], t) for k, t in ((1, pa.int32()), (2, pa.int64()), (3, pa.int32()), (4, pa.list_(pa.int32())))]
        yield pa.RecordBatch.from_arrays([*keys.columns, *extra], names=["_id", *_KEY, "_seq", "_rank", "_need", "_runs"])


def _pairs(batches: Iterator[pa.RecordBatch], half: int) -> Iterator[pa.RecordBatch]:
    """The ranks of the two halves of every run of ``2 * half`` lines that must be ranked."""
    level = half.bit_length()
    for batch in batches:
        rows: list[tuple] = []
        for i, lines in enumerate(batch.column("_lines").to_pylist()):
            rank = {x["_seq"]: x["_rank"] for x in lines}
            rows += [(i, x["_seq"], x["_rank"], rank[x["_seq"] + half], x["_need"]) for x in lines if x["_need"] >= level and x["_seq"] + half in rank]
        keys = batch.select(["_id", *_KEY]).take(pa.array([r[0] for r in rows], pa.int32()))
        extra = [pa.array([r[k] for r in rows], t) for k, t in ((1, pa.int32()), (2, pa.int64()), (3, pa.int64()), (4, pa.int32()))]
        yield pa.RecordBatch.from_arrays([*keys.columns, *extra], names=["_id", *_KEY, "_seq", "_a", "_b", "_need"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each run by its length and the ranks of the two overlapping powers of two that cover it."""
    for batch in batches:
        rows: list[tuple] = []
        for i, lines in enumerate(batch.column("_lines").to_pylist()):
            rank = {(x["_level"], x["_seq"]): x["_rank"] for x in lines}
            for x in lines:
                for n in x["_runs"] or ():
                    level = n.bit_length() - 1
                    a, b = rank.get((level, x["_seq"])), rank.get((level, x["_seq"] + n - (1 << level)))
                    if a is not None and b is not None:
                        rows.append((i, x["_seq"], n, a, b))
        keys = batch.select(["_id", *_KEY]).take(pa.array([r[0] for r in rows], pa.int32()))
        extra = [pa.array([r[k] for r in rows], t) for k, t in ((1, pa.int32()), (2, pa.int32()), (3, pa.int64()), (4, pa.int64()))]
        yield pa.RecordBatch.from_arrays([*keys.columns, *extra], names=["_id", *_KEY, "_seq", "_n", "_a", "_b"])


def _delete(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, counts = [], []
        for text, runs in zip(batch.column(text_at).to_pylist(), batch.column("_gone").to_pylist()):
            if not runs:
                texts.append(text)
                counts.append(0)
                continue
            gone = {at for r in runs for at in range(r["_seq"], r["_seq"] + r["_n"])}
            left, seq = [], 0
            for line in text.encode().split(b"\n"):
                if line.strip(SPACES):
                    if seq not in gone:
                        left.append(line)
                    seq += 1
                else:
                    left.append(line)
            texts.append(b"\n".join(left).decode())
            counts.append(len(gone))
        columns = batch.columns[:-1]
        columns[text_at] = pa.array(texts, pa.string())
        yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())], names=[*batch.schema.names[:-1], RESULT])


def _by_document(df: DataFrame, *columns: str) -> DataFrame:
    """A row per document with its lines; a group is never larger than one document."""
    return df.groupBy("_id", *_KEY).agg(F.collect_list(F.struct(*columns)).alias("_lines"))


def repeated_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """Every sufficient run that has an earlier copy: ``_id``, key, ``_seq`` (first line), ``_n`` (lines).

    Lines are counted from 0 over the lines with a word.
    """
    ship(df.sparkSession)
    k1, k2 = doc_key(id_col, text_col)
    kind = df.schema[id_col].dataType.simpleString()
    head = f"_id {kind}, _k1 long, _k2 long, _seq int"
    texts = df.select(F.col(id_col).alias("_id"), k1.alias("_k1"), k2.alias("_k2"), F.col(text_col).cast("binary").alias("_text"))
    members, order = ["_id", *_KEY, "_seq"], [F.col("_id").asc_nulls_last(), F.col("_k1"), F.col("_k2"), F.col("_seq")]
    lines = materialize(texts.mapInArrow(_numbers, f"{head}, _words int, _a long, _b long"), "lines")
    shared = number_groups(lines, ["_a", "_b"], members, order)
    per_doc = _by_document(shared, "_seq", "_words", "group")
    base = materialize(per_doc.mapInArrow(partial(_depths, min_words=min_words), f"{head}, _rank long, _need int, _runs array<int>"), "line_ranks")
    deepest = base.agg(F.max("_need")).first()[0]
    level, half = base, 1
    levels = [base.select(*members, F.lit(0).alias("_level"), "_rank", "_runs")]
    for depth in range(1, (deepest or 0) + 1):
        pairs = _by_document(level.filter(F.col("_need") >= depth - 1), "_seq", "_rank", "_need").mapInArrow(partial(_pairs, half=half), f"{head}, _a long, _b long, _need int")
        level = number_groups(pairs, ["_a", "_b"], members, order).select(*members, F.col("group").alias("_rank"), "_need")
        levels.append(level.select(*members, F.lit(depth).alias("_level"), "_rank", F.lit(None).cast("array<int>").alias("_runs")))
        half *= 2
    ranks = reduce(DataFrame.unionByName, levels)
    windows = _by_document(ranks, "_level", "_seq", "_rank", "_runs").mapInArrow(_windows, f"{head}, _n int, _a long, _b long")
    return number_groups(windows, ["_n", "_a", "_b"], members, order).filter("later").select(*members, "_n")


def delete_repeated_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``df`` without the lines of later copies of repeated runs, and ``n_deleted_lines``."""
    rest = set_aside(df, RESULT, "_k1", "_k2", "_d1", "_d2", "_gone")
    runs = repeated_runs(rest, id_col, text_col, min_words)
    gone = runs.groupBy(F.col("_k1").alias("_d1"), F.col("_k2").alias("_d2")).agg(F.collect_list(F.struct("_seq", "_n")).alias("_gone"))
    gone = materialize(gone, "deleted_runs")
    k1, k2 = doc_key(id_col, text_col)
    keyed = rest.withColumns({"_k1": k1, "_k2": k2})
    joined = keyed.join(gone.hint("merge"), (keyed["_k1"] == gone["_d1"]) & (keyed["_k2"] == gone["_d2"]), "left").select(*[f"`{c}`" for c in rest.columns], "_gone")
    at = [c.lower() for c in rest.columns].index(text_col.lower())
    return joined.mapInArrow(partial(_delete, text_at=at), extended(rest.schema, f"{RESULT} long"))
