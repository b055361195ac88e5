"""Token ids in files: frequency ranks in byte-aligned variable-length coding.

All texts are encoded once, into rows of compressed ids in the shared folder, from which the ids are counted;
the most frequent id gets rank 0, and so on. The rows, not the texts, are then sorted by document. Ranks are
stored in one to four bytes each, all lengths apart in control bytes: two bits per value, four
values per control byte. Decoding looks the lengths of four values up by control byte, and takes
all values of a block from the bytes at once.

A data set is a folder: ``ranks`` (ids by rank) and shards in ascending id order of the documents,
each a row of blocks with document ids, token counts and ranks under a checksum. Shards hold what
one task writes, in blocks of about ``BLOCK_TOKENS`` tokens, so reading needs memory for a block
only. The table of shards gives each shard's first token position.

Defined results: a null or empty text is its end id alone. Null document ids stand last, and rows of
one id in any order, each stored; they may be dealt to several shards. An empty table gives no shards.
Other columns are not stored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.shared_files import make_folder, new_file, open_file, read_exactly
from millrace.llm.support import large_batches, ship, small_batches
from millrace.llm.token_ids import encode, encoder
from millrace.storage import materialize

MAGIC, VERSION = b"FRVB", 1
HEAD = struct.Struct("<4sI")
BLOCK = struct.Struct("<QQQQQI")  # documents, tokens, bytes of counts, control and data, checksum
BLOCK_TOKENS = 1 << 20

#: Lengths of the four values of each control byte.
LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], np.int64)
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def pack_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit values; the last control byte is filled with zeros."""
    values = np.ascontiguousarray(values, "<u4")
    sizes = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    code = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    code[: len(values)] = sizes - 1
    control = (code.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) < sizes[:, None]]
    return control.tobytes(), data.tobytes()


def unpack_values(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of :func:`pack_values`, by table lookup."""
    sizes = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    if len(sizes) != n or sizes.sum() != len(data):
        raise ValueError("control bytes and data do not fit")
    at = np.cumsum(sizes) - sizes
    body = np.frombuffer(data + b"\0\0\0", np.uint8).astype(np.uint32)
    value = body[at] | body[at + 1] << 8 | body[at + 2] << 16 | body[at + 3] << 24
    return value & MASKS[sizes]


def _encode(batches: Iterator[pa.RecordBatch], path: str, end_id: int, kind: str, batch_bytes: int) -> Iterator[pa.RecordBatch]:
    pressed = zstandard.ZstdCompressor()
    for whole in large_batches(batches, "_text", batch_bytes):
        for batch in small_batches(whole, "_text", batch_bytes):
            ids, at = encode(batch.column("_text"), path, True, end_id)
            ids = ids.astype(kind)
            cells = pa.array([pressed.compress(ids[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("_id"), cells], names=["_id", "_ids"])


def _plain(batches: Iterator[pa.RecordBatch], kind: str, most: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Rows of :func:`_encode` with their ids, about ``most`` ids at a time, however small the compressed rows are."""
    opened = zstandard.ZstdDecompressor()
    for batch in batches:
        first, held, tokens = 0, [], 0
        for i, cell in enumerate(batch.column("_ids")):
            held.append(np.frombuffer(opened.decompress(cell.as_buffer()), kind))
            tokens += len(held[-1])
            if tokens >= most or i + 1 == batch.num_rows:
                yield batch.slice(first, len(held)), held
                first, held, tokens = i + 1, [], 0


def _count(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    totals = np.zeros(0, np.int64)
    for _, texts in _plain(batches, kind):
        counts = np.bincount(np.concatenate(texts))
        totals = np.pad(totals, (0, max(0, len(counts) - len(totals))))
        totals[: len(counts)] += counts
    some = np.flatnonzero(totals)
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(totals[some], pa.int64())], names=["token", "n"])


def ids_by_frequency(encoded: DataFrame, kind: str) -> np.ndarray:
    """All ids in use, the most frequent first; never more than the vocabulary holds."""
    counted = encoded.select("_ids").mapInArrow(partial(_count, kind=kind), "token long, n long")
    rows = counted.groupBy("token").agg(F.sum("n").alias("n")).collect()
    return np.array([r["token"] for r in sorted(rows, key=lambda r: (-r["n"], r["token"]))], np.uint32)


def _block(doc_ids: list[int | None], counts: np.ndarray, ranks: np.ndarray) -> bytes:
    numbers = struct.pack(f"<{len(doc_ids)}q", *[0 if d is None else d for d in doc_ids])
    known = np.packbits([d is not None for d in doc_ids]).tobytes()
    count_control, count_data = pack_values(counts)
    control, data = pack_values(ranks)
    body = numbers + known + count_control + count_data + control + data
    return BLOCK.pack(len(doc_ids), len(ranks), len(count_data), len(control), len(data), zlib.crc32(body)) + body


def _write(batches: Iterator[pa.RecordBatch], kind: str, folder: str, by_rank: np.ndarray) -> Iterator[pa.RecordBatch]:
    rank_of = np.zeros(int(by_rank.max(initial=0)) + 1, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    part = TaskContext.get().partitionId()
    name = f"{folder}/part-{part:06d}.frvb"
    tokens = documents = 0
    held: list[tuple[list, np.ndarray, np.ndarray]] = []
    with new_file(name) as out:
        out.write(HEAD.pack(MAGIC, VERSION))

        def flush() -> None:
            out.write(_block([d for h in held for d in h[0]], np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])))
            held.clear()

        for batch, texts in _plain(batches, kind):
            counts = np.array([len(ids) for ids in texts], np.int64)
            held.append((batch.column("_id").to_pylist(), counts, rank_of[np.concatenate(texts)]))
            tokens += int(counts.sum())
            documents += batch.num_rows
            if sum(len(h[2]) for h in held) >= BLOCK_TOKENS:
                flush()
        if held:
            flush()
    if documents:
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([name]), pa.array([documents], pa.int64()), pa.array([tokens], pa.int64())], names=["shard", "path", "documents", "tokens"])


def write_ids(df: DataFrame, folder: str, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, batch_bytes: int = 12 << 20) -> DataFrame:
    """Write a data set in ascending order of ``id_col`` (a whole number); the table of its shards comes back."""
    ship(df.sparkSession)
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    kind = "<u2" if max(encoder(path).whole.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
    rows = docs.mapInArrow(partial(_encode, path=path, end_id=end_id, kind=kind, batch_bytes=batch_bytes), "_id long, _ids binary")
    # The number of a row spreads copies of one document; it is stored, so that it does not change in a second try.
    encoded = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "encoded")
    by_rank = ids_by_frequency(encoded, kind)
    make_folder(folder)
    with new_file(f"{folder}/ranks") as out:
        out.write(HEAD.pack(MAGIC, VERSION) + by_rank.astype("<u4").tobytes())
    order = [F.col("_id").asc_nulls_last(), F.col("_row")]
    placed = encoded.repartitionByRange(*order).sortWithinPartitions(*order).select("_id", "_ids")
    written = placed.mapInArrow(partial(_write, kind=kind, folder=folder, by_rank=by_rank), "shard long, path string, documents long, tokens long")
    return materialize(written, "shards")


def read_ranks(folder: str) -> np.ndarray:
    with open_file(f"{folder}/ranks") as stream:
        data = stream.read()
    if data[:4] != MAGIC:
        raise ValueError("no file of ranks")
    return np.frombuffer(data[HEAD.size :], "<u4")


def read_blocks(path: str, by_rank: np.ndarray) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """(document ids, token counts, token ids) of each block of a shard, checked."""
    with open_file(path) as stream:
        if HEAD.unpack(read_exactly(stream, HEAD.size)) != (MAGIC, VERSION):
            raise ValueError(f"{path} is no shard of ids")
        while head := read_exactly(stream, BLOCK.size):
            documents, tokens, count_bytes, control_bytes, data_bytes, checksum = BLOCK.unpack(head)
            sizes = [8 * documents, -(-documents // 8), -(-documents // 4), count_bytes, control_bytes, data_bytes]
            body = read_exactly(stream, sum(sizes))
            if len(body) != sum(sizes) or zlib.crc32(body) != checksum:
                raise ValueError(f"{path} is damaged")
            ends = np.cumsum(sizes).tolist()
            numbers, known, count_control, count_data, control, data = [body[e - n : e] for e, n in zip(ends, sizes)]
            given = np.unpackbits(np.frombuffer(known, np.uint8), count=documents)
            doc_ids = [d if g else None for d, g in zip(struct.unpack(f"<{documents}q", numbers), given.tolist())]
            counts = unpack_values(count_control, count_data, documents).astype(np.int64)
            yield doc_ids, counts, by_rank[unpack_values(control, data, tokens)]


def _read(batches: Iterator[pa.RecordBatch], folder: str, with_ids: bool) -> Iterator[pa.RecordBatch]:
    by_rank = read_ranks(folder)
    for batch in batches:
        for path, start in zip(batch.column("path").to_pylist(), batch.column("first").to_pylist()):
            for doc_ids, counts, ids in read_blocks(path, by_rank):
                at = np.concatenate(([0], np.cumsum(counts)))
                little = ids.astype("<u4")
                sums = [zlib.crc32(little[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                columns = [pa.array(doc_ids, pa.int64()), pa.array(start + at[:-1], pa.int64()), pa.array(counts, pa.int64()), pa.array(sums, pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)
                start += len(ids)


def read_ids(spark: SparkSession, folder: str, shards: DataFrame, with_ids: bool = True) -> DataFrame:
    """Every document of a data set: id, position of its first token, tokens, checksum, and its ids if asked for."""
    ship(spark)
    first, rows = 0, []
    for r in sorted(shards.select("shard", "path", "tokens").collect()):  # a row per writing task
        rows.append((r["shard"], r["path"], first))
        first += r["tokens"]
    table = spark.createDataFrame(rows, "shard long, path string, first long")
    spread = table.repartition(max(1, len(rows)), "shard") if rows else table
    return spread.mapInArrow(partial(_read, folder=folder, with_ids=with_ids), "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else ""))
