"""WARC archives in Zstandard: one frame per record, with a shared dictionary in front.

An archive begins with a skippable frame that holds the dictionary (itself possibly compressed);
every later frame is one record. Records are WARC/1.1 responses holding an HTTP message, or
revisits of an equal payload, whose HTTP header stands without the body. Reading streams a file frame by
frame, so it needs memory for one record, and checks version, required fields, lengths and digests.

Of the pages with equal payloads of at least ``min_revisit`` bytes, that with the largest id is the
response. Payloads are compared by SHA-1 and length; sizes of groups are summed before any shuffle,
and pages meet only the groups that have more than one.

Defined results: a null page is an empty payload; a null URL has no field; a null id has none
either, and is a revisit if its payload's group has an id. Rows that share the largest id of a group
are all responses. Tables with too few pages to train on get no dictionary; empty tables, no files.
Other columns are not stored. Control characters in a URL are percent-encoded.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.shared_files import make_folder, new_file, open_file
from millrace.llm.support import ship
from millrace.storage import materialize

MIN_REVISIT = 1000
ARCHIVE_BYTES = 256 << 20
DICTIONARY_BYTES = 64 << 10
TRAIN_PAGES = 400
TRAIN_BYTES = 6 << 20
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"
# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")


def _record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page}/{digest}')}>"


def _field_text(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def build_record(page: int | None, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One record; ``payload`` None is a revisit of the page ``refers_to``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    fields = [
        ("WARC-Type", "revisit" if payload is None else "response"),
        ("WARC-Record-ID", _record_id(page, digest)),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("WARC-Block-Digest", "sha1:" + base64.b32encode(hashlib.sha1(block, usedforsecurity=False).digest()).decode()),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", _field_text(url)))
    if page is not None:
        fields.append(("X-Page-ID", str(page)))
    if payload is None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _record_id(refers_to, digest)), ("X-Refers-To-Page", str(refers_to))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse_fields(lines: list[bytes]) -> dict[str, str]:
    out = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise ValueError(f"no header field: {line[:80]!r}")
        out[name.strip().decode().lower()] = value.strip().decode()
    return out


def parse_record(data: bytes) -> dict[str, object]:
    """Fields and payload of one record; anything that does not fit is an error."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    if not gap or first not in (b"WARC/1.0", b"WARC/1.1"):
        raise ValueError("no WARC record")
    fields = parse_fields(lines)
    missing = [k for k in REQUIRED if k not in fields]
    if missing:
        raise ValueError(f"required fields are missing: {missing}")
    size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError("the block has not the length its header gives")
    block = rest[:size]
    http, gap, payload = block.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("the HTTP header does not end")
    stated = int(parse_fields(http.split(b"\r\n")[1:])["content-length"])
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    if "warc-block-digest" in fields and base64.b32decode(fields["warc-block-digest"].removeprefix("sha1:")) != hashlib.sha1(block, usedforsecurity=False).digest():
        raise ValueError("the block has not the digest its header gives")
    kind = fields["warc-type"]
    if kind == "response":
        if len(payload) != stated or hashlib.sha1(payload, usedforsecurity=False).hexdigest() != digest:
            raise ValueError("the payload has not the length or digest its header gives")
    elif kind == "revisit":
        if payload or "warc-refers-to" not in fields:
            raise ValueError("a revisit has a payload, or refers to nothing")
    else:
        raise ValueError(f"unknown record type {kind!r}")
    page, refers = fields.get("x-page-id"), fields.get("x-refers-to-page")
    return {
        "page_id": int(page) if page is not None else None, "url": fields.get("warc-target-uri"), "payload_bytes": stated, "payload_digest": digest,
        "record_type": kind, "refers_to": int(refers) if refers is not None else None, "payload": payload if kind == "response" else None,
    }


def read_frames(stream, piece: int = 1 << 18) -> Iterator[bytes]:
    """Content of each frame of an archive, one at a time; the dictionary is taken from the front."""
    held = b""

    def more(size: int) -> None:
        nonlocal held
        while len(held) < size:
            got = stream.read(piece)
            if not got:
                raise ValueError("the archive ends within a frame")
            held += got

    tool, first = zstandard.ZstdDecompressor(), True
    while held or (held := stream.read(piece)):
        more(4)
        magic = struct.unpack("<I", held[:4])[0]
        if magic in SKIPPABLE:
            more(8)
            size = struct.unpack("<I", held[4:8])[0]
            more(8 + size)
            content, held = held[8 : 8 + size], held[8 + size :]
            if first and magic == DICTIONARY_MAGIC:
                if content[:4] == FRAME_MAGIC:
                    content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
                tool = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
        else:
            frame, parts = tool.decompressobj(), []
            while True:
                parts.append(frame.decompress(held))
                if frame.eof:
                    held = frame.unused_data
                    break
                held = stream.read(piece)
                if not held:
                    raise ValueError("the archive ends within a frame")
            yield b"".join(parts)
        first = False


def train_dictionary(pages: DataFrame, id_col: str, html_col: str) -> bytes | None:
    """A dictionary from at most ``TRAIN_PAGES`` pages in hash order and ``TRAIN_BYTES`` of text."""
    fit = pages.filter(F.octet_length(html_col).between(1, TRAIN_BYTES // 100) & F.col(id_col).isNotNull())
    # Ids first: a task sends its first ids to the driver, not its first pages.
    chosen = fit.select(F.col(id_col).alias("_chosen")).distinct().orderBy(F.xxhash64("_chosen"), "_chosen").limit(TRAIN_PAGES)
    rows = fit.join(F.broadcast(chosen), F.col(id_col) == F.col("_chosen")).select(id_col, html_col).limit(TRAIN_PAGES).collect()
    samples, left = [], TRAIN_BYTES
    for r in rows:
        text = r[html_col].encode()
        if len(text) <= left:
            samples.append(text)
            left -= len(text)
    if len(samples) < 8:
        return None
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, samples)) // 8), samples).as_bytes()
    except zstandard.ZstdError:
        return None  # too little to train on


def _write(batches: Iterator[pa.RecordBatch], folder: str, dictionary: bytes | None, most: int) -> Iterator[pa.RecordBatch]:
    part, number = TaskContext.get().partitionId(), 0
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    tool = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_checksum=True, write_content_size=True)
    rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns]))
    row = next(rows, None)
    done: list[tuple[str, int]] = []
    while row is not None:
        name, size, records = f"{folder}/part-{part:06d}-{number:04d}.warc.zst", 0, 0
        with new_file(name) as out:
            if dictionary:
                packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
                out.write(struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed)
            while row is not None and size < most:
                page, url, payload, length, digest, refers_to = row
                frame = tool.compress(build_record(page, url, payload, length, digest, refers_to))
                out.write(frame)
                size += len(frame)
                records += 1
                row = next(rows, None)
        done.append((name, records))
        number += 1
    if done:
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done]), pa.array([d[1] for d in done], pa.int64())], names=["path", "records"])


def write_archives(
    df: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    min_revisit: int = MIN_REVISIT, archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write every row of ``df`` as a record; the table of the files comes back."""
    ship(df.sparkSession)
    text = F.coalesce(html_col, F.lit(""))
    pages = df.select(F.col(id_col).cast("long").alias("_id"), F.col(url_col).alias("_url"), text.cast("binary").alias("_payload"), F.octet_length(text).cast("long").alias("_size"), F.sha1(text.cast("binary")).alias("_digest"))
    sized = pages.filter(F.col("_size") >= min_revisit).groupBy("_digest", "_size").agg(F.max("_id").alias("_keeper"), F.count(F.lit(1)).alias("_n"))
    groups = materialize(sized.filter("_n > 1 and _keeper is not null").select(F.col("_digest").alias("_d"), F.col("_size").alias("_s"), "_keeper"), "equal_payloads")
    stored = pages.join(groups, (F.col("_digest") == F.col("_d")) & (F.col("_size") == F.col("_s")), "left")
    again = F.col("_keeper").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_keeper"))
    ready = stored.select("_id", "_url", F.when(~again, F.col("_payload")).alias("_payload"), "_size", "_digest", F.when(again, F.col("_keeper")).alias("_refers_to"))
    dictionary = train_dictionary(df.select(id_col, html_col), id_col, html_col)
    make_folder(folder)
    written = ready.mapInArrow(partial(_write, folder=folder, dictionary=dictionary, most=archive_bytes), "path string, records long")
    return materialize(written, "archives")


def _read(batches: Iterator[pa.RecordBatch], with_payload: bool) -> Iterator[pa.RecordBatch]:
    kinds = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}
    if with_payload:
        kinds["payload"] = pa.binary()

    def as_batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in kinds.items()], names=list(kinds))

    for batch in batches:
        for path in batch.column("path").to_pylist():
            rows, size = [], 0
            with open_file(path) as stream:
                for data in read_frames(stream):
                    record = parse_record(data)
                    size += len(record["payload"] or b"") if with_payload else 1
                    rows.append({k: record[k] for k in kinds})
                    if size > 8 << 20 or len(rows) == 4096:
                        yield as_batch(rows)
                        rows, size = [], 0
            if rows:
                yield as_batch(rows)


def read_archives(spark: SparkSession, paths: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records of the archives named in column ``path``; a file is read by one task, as a stream."""
    ship(spark)
    kinds = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + (", payload binary" if with_payload else "")
    # A number of its own: Spark would merge these few bytes into one task, but each row is a file to read.
    spread = paths.select("path").repartition(max(1, paths.count()))
    return spread.mapInArrow(partial(_read, with_payload=with_payload), kinds)
