"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.storage import ship_package

# Arrow's other pools keep what they once held; workers live as long as an executor.
pa.set_memory_pool(pa.system_memory_pool())

BATCH_BYTES = 2 << 20
ARROW_BYTES = 4 << 20
BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Make the session ready for tasks of this package.

    Executors get the package, once per application, whatever their working folder is. Batches
    between Spark and Python are bounded in bytes, as rows may hold very long texts; a bound that the
    cluster's own configuration gives stays.
    """
    if not spark.sparkContext.getConf().contains(BATCH_KEY):
        spark.conf.set(BATCH_KEY, ARROW_BYTES)
    ship_package(spark)


def small_batches(batch: pa.RecordBatch, column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``most`` bytes of ``column`` each, or one row."""
    if not batch.num_rows:
        return
    sizes = byte_lengths(batch.column(column))
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and total + size > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    yield batch.slice(start)


def large_batches(batches: Iterator[pa.RecordBatch], column: str, least: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in batches of about ``least`` bytes of ``column``, or one row that has more."""
    held: list[pa.RecordBatch] = []
    size = 0

    def joined() -> Iterator[pa.RecordBatch]:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    for batch in batches:
        for part in small_batches(batch, column, least):
            if held and size + part.column(column).nbytes > least:
                yield from joined()
                held, size = [], 0
            held.append(part)
            size += part.column(column).nbytes
    if held:
        yield from joined()


def byte_lengths(texts: pa.Array) -> np.ndarray:
    return np.diff(text_buffer(texts)[1])


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after another, and their offsets; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else pa.binary()
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else "")
    raw = texts.cast(kind)
    width = np.int64 if kind == pa.large_binary() else np.int32
    _, offsets, data = raw.buffers()
    if not len(raw) or offsets is None:
        return np.empty(0, np.uint8), np.zeros(len(raw) + 1, np.int64)
    at = np.frombuffer(offsets, width)[raw.offset : raw.offset + len(raw) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.empty(0, np.uint8)
    return body, at - at[0]


def kept_columns(df: DataFrame, keep: list[str] | None, results: Iterable[str]) -> list[str]:
    """Columns to pass on: those asked for (all by default), without any that a result's name replaces."""
    taken = {r.lower() for r in results}
    return [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]


def set_aside(df: DataFrame, *used: str) -> DataFrame:
    """``df`` without columns whose names the operator needs for itself."""
    return df.select(*[F.col(f"`{c}`") for c in kept_columns(df, None, used)])


def extended(schema: StructType, fields: str) -> StructType:
    """A new schema with the named and typed fields (``"a long, b array<int>"``) after those given."""
    return StructType([*schema.fields, *StructType.fromDDL(fields).fields])


def doc_key(id_col: str, text_col: str) -> tuple[Column, Column]:
    """Two 64-bit numbers that tell documents apart: equal for rows of equal id and text only."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    name = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    return F.xxhash64(F.lit(1), name, text), F.xxhash64(F.lit(2), F.crc32(F.encode(text, "utf-8")), name, text)


def map_arrow(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str) -> DataFrame:
    """``df.mapInArrow``, also for columns whose names hold dots, which it does not find."""
    if not any("." in c for c in df.columns):
        return df.mapInArrow(work, schema)
    plain = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return plain.mapInArrow(partial(_with_names, names=df.columns, work=work), schema)


def _with_names(batches: Iterator[pa.RecordBatch], names: list[str], work: Callable) -> Iterator[pa.RecordBatch]:
    return work(batch.rename_columns(names) for batch in batches)
