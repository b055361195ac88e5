"""Numbering of groups of equal rows in one global sort, for groups of any size.

Rows are range-partitioned and sorted on the key columns and then on columns that tell the members
of a group apart, so a group that holds a third of all rows is spread over many tasks. Each task
numbers its own groups in one pass; only the first and last key of each task are gathered, which
says where a group goes on in the next task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.support import extended, ship
from millrace.storage import materialize

_ADDED = "_group long, _prev boolean, _next boolean, _edge int, _part int"
FIRST, LAST = 1, 2


def _same_as_before(table: pa.Table, names: Sequence[str]) -> np.ndarray:
    """For each row but the first, whether all named columns equal those of the row before."""
    out = np.ones(max(len(table) - 1, 0), bool)
    for name in names:
        column = table.column(name).combine_chunks()
        known = np.asarray(column.is_valid())
        values = column.fill_null(0).to_numpy(zero_copy_only=False) if pa.types.is_integer(column.type) else np.array(column.to_pylist(), object)
        out &= (values[1:] == values[:-1]) & (known[1:] == known[:-1])
    return out


def _number(batches: Iterator[pa.RecordBatch], keys: list[str], members: list[str], only_shared: bool) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    held: pa.Table | None = None
    group, equal_before, begun = 0, False, False

    def emit(rows: pa.Table, groups: np.ndarray, prev: np.ndarray, nxt: np.ndarray, edge: np.ndarray) -> list[pa.RecordBatch]:
        for name, values, kind in (("_group", groups, pa.int64()), ("_prev", prev, pa.bool_()), ("_next", nxt, pa.bool_()), ("_edge", edge, pa.int32()), ("_part", np.full(len(rows), part), pa.int32())):
            rows = rows.append_column(name, pa.array(values, kind))
        if only_shared:
            rows = rows.filter(pa.array(prev | nxt | (edge > 0)))
        return rows.combine_chunks().to_batches()

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        # Rows that agree in everything are one row; they always meet in one task.
        twin = _same_as_before(rows, [*keys, *members])
        if twin.any():
            rows = rows.filter(pa.array(np.concatenate(([True], ~twin))))
        equal = _same_as_before(rows, keys)
        n = len(rows) - 1  # the last row waits for what follows it
        if n:
            groups = group + np.concatenate(([0], np.cumsum(~equal[:-1]))) if n > 1 else np.array([group])
            edge = np.zeros(n, np.int32)
            edge[0] = 0 if begun else FIRST
            begun = True
            yield from emit(rows.slice(0, n), groups, np.concatenate(([equal_before], equal[:-1])), equal, edge)
            group, equal_before = int(groups[-1]) + int(not equal[-1]), bool(equal[-1])
        held = rows.slice(n)
    if held is not None:
        yield from emit(held, np.array([group]), np.array([equal_before]), np.array([False]), np.array([LAST if begun else FIRST | LAST], np.int32))


def number_groups(df: DataFrame, keys: Sequence[str], members: Sequence[str], order: Sequence[Column] | None = None, only_shared: bool = True) -> DataFrame:
    """``df`` with ``group`` (dense, by key order), ``shared`` and ``later``; rows equal in all of keys and members once.

    ``order`` sorts the members of a group (their columns, by default). ``shared``: another row has
    the same key. ``later``: such a row comes before this one. With ``only_shared`` the others are
    left out.
    """
    spark = df.sparkSession
    ship(spark)
    placing = [*[F.col(k) for k in keys], *(order or [F.col(m) for m in members])]
    placed = df.repartitionByRange(*placing).sortWithinPartitions(*placing)
    numbered = placed.mapInArrow(partial(_number, keys=list(keys), members=list(members), only_shared=only_shared), extended(df.schema, _ADDED))
    stage = materialize(numbered, "groups")
    edges = stage.filter("_edge > 0").select("_part", "_edge", "_group", *keys).collect()
    first = {r["_part"]: tuple(r[k] for k in keys) for r in edges if r["_edge"] & FIRST}
    last = {r["_part"]: (tuple(r[k] for k in keys), r["_group"]) for r in edges if r["_edge"] & LAST}
    offsets, base, before = [], 0, None
    for part in sorted(first):
        joined = before is not None and first[part] == last[before][0]
        if joined:
            offsets[-1][3] = True
        offsets.append([part, base - int(joined), joined, False])
        base += last[part][1] + 1 - int(joined)
        before = part
    known = spark.createDataFrame([tuple(o) for o in offsets], "_part int, _base long, _from boolean, _to boolean")
    full = stage.join(F.broadcast(known), "_part")
    later = F.col("_prev") | ((F.col("_edge").bitwiseAND(FIRST) > 0) & F.col("_from"))
    shared = later | F.col("_next") | ((F.col("_edge").bitwiseAND(LAST) > 0) & F.col("_to"))
    out = full.select(*df.columns, (F.col("_base") + F.col("_group")).alias("group"), shared.alias("shared"), later.alias("later"))
    return out.filter("shared") if only_shared else out
