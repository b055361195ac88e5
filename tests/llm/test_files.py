"""Files of ids and WARC archives: exact round trips, damage is noticed."""

import io
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm import vbyte_files, warc
from millrace.storage import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=70))
@settings(max_examples=60, deadline=None)
def test_values_round_trip(values):
    control, data = vbyte_files.pack_values(np.array(values, np.uint32))
    assert vbyte_files.unpack_values(control, data, len(values)).tolist() == values


def test_ids_round_trip_in_order(spark):
    rows = [(9, "the cat"), (2, None), (5, ""), (None, "last"), (7, "the the the"), (7, "a tie"), (2, None), (1, "x" * 50)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, start int").repartition(3)
    folder = scratch_path(spark, "ids")
    shards = vbyte_files.write_ids(df, folder, PATH)
    got = vbyte_files.read_ids(spark, folder, shards).toPandas().sort_values("start")
    tool = Tokenizer.from_file(PATH)
    want = sorted((r[0] if r[0] is not None else 1 << 60, tuple(tool.encode(r[1] or "", add_special_tokens=False).ids + [0])) for r in rows)
    assert sorted((int(d) if d == d else 1 << 60, tuple(i)) for d, i in zip(got["doc_id"], got["ids"])) == want
    assert got["doc_id"].fillna(1 << 60).is_monotonic_increasing
    assert got["start"].tolist() == (np.cumsum(got["n_tokens"]) - got["n_tokens"]).tolist()
    assert all(zlib.crc32(np.array(r.ids, "<u4")) == r.ids_crc32 for r in got.itertuples())
    by_rank = vbyte_files.read_ranks(folder)
    counts = np.bincount(np.concatenate(got["ids"].tolist()))
    assert (np.diff(counts[by_rank]) <= 0).all() and by_rank[0] == counts.argmax()
    empty = scratch_path(spark, "ids")
    assert vbyte_files.read_ids(spark, empty, vbyte_files.write_ids(df.limit(0), empty, PATH)).count() == 0


def test_a_damaged_shard_is_refused(spark, tmp_path):
    folder = str(tmp_path)
    shards = vbyte_files.write_ids(spark.createDataFrame([(1, "some text")], "doc_id long, text string"), folder, PATH)
    path = shards.first()["path"]
    data = bytearray(open(path, "rb").read())
    data[-1] ^= 1
    open(path, "wb").write(bytes(data))
    with pytest.raises(ValueError, match="damaged"):
        list(vbyte_files.read_blocks(path, vbyte_files.read_ranks(folder)))


def test_archives_round_trip(spark):
    long = "<p>" + "y" * 1500
    rows = [(1, "http://a", None), (2, None, long), (3, "u", long), (3, "u", long), (None, "q \n", long), (5, "z", "é" * 500), (6, "z", "é" * 500), (7, "w", "é" * 499), (8, "w", "é" * 499)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string").repartition(3)
    files = warc.write_archives(df, scratch_path(spark, "warc"), archive_bytes=300)
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to, r.payload and r.payload.decode()) for r in warc.read_archives(spark, files).collect()), key=str)
    want = [(1, 0, "response", None, b""), (2, 1503, "revisit", 3, None), (3, 1503, "response", None, long), (3, 1503, "response", None, long), (None, 1503, "revisit", 3, None)]
    want += [(5, 1000, "revisit", 6, None), (6, 1000, "response", None, "é" * 500), (7, 998, "response", None, "é" * 499), (8, 998, "response", None, "é" * 499)]
    assert got == sorted(want, key=str)
    none = warc.write_archives(df.limit(0), scratch_path(spark, "warc"))
    assert warc.read_archives(spark, none).count() == 0


def archive(records, dictionary=None):
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    tool = zstandard.ZstdCompressor(dict_data=shared)
    front = b""
    if dictionary:
        front = warc.struct.pack("<II", warc.DICTIONARY_MAGIC, len(dictionary)) + dictionary
    return front + b"".join(tool.compress(r) for r in records)


def test_frames_come_one_by_one_with_a_plain_dictionary():
    import hashlib

    texts = [b"<html>" + bytes([65 + i]) * (700 * i) for i in range(9)]
    records = [warc.build_record(i, "u", t, len(t), hashlib.sha1(t).hexdigest(), None) for i, t in enumerate(texts)]
    dictionary = zstandard.train_dictionary(4096, [b"<html> common words of all pages %d" % (i * i) * 5 for i in range(400)]).as_bytes()
    for held in (None, dictionary):
        data = archive(records, held)
        for piece in (7, 1 << 18):
            assert list(warc.read_frames(io.BytesIO(data), piece)) == records
        with pytest.raises(ValueError, match="ends within a frame"):
            list(warc.read_frames(io.BytesIO(data[:-3])))
    assert [warc.parse_record(r)["payload"] for r in records] == texts


@pytest.mark.parametrize("old, new", [(b"WARC/1.1", b"WARC/3.0"), (b"WARC-Date: ", b"X-Date: "), (b"Content-Length: 5\r\n\r\nhello", b"Content-Length: 4\r\n\r\nhello"), (b"hello", b"hallo"), (b"hello", b"hell"), (b"WARC-Type: response", b"WARC-Type: other")])
def test_bad_records_are_refused(old, new):
    import hashlib

    record = warc.build_record(1, "u", b"hello", 5, hashlib.sha1(b"hello").hexdigest(), None)
    assert warc.parse_record(record)["payload"] == b"hello"
    assert old in record
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(old, new))


def test_rows_are_opened_a_bounded_number_of_ids_at_a_time():
    """However well rows compress, and one row may have more than the bound."""
    sizes = [1, 400, 400, 400, 5000, 1, 1]
    cells = [zstandard.ZstdCompressor().compress(np.full(n, 7, "<u2")) for n in sizes]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(cells, pa.binary())], names=["_id", "_ids"])
    parts = [(b.column("_id").to_pylist(), [len(x) for x in texts]) for b, texts in vbyte_files._plain([batch], "<u2", most=800)]
    assert parts == [([0, 1, 2], [1, 400, 400]), ([3, 4], [400, 5000]), ([5, 6], [1, 1])]
