"""Packing: exact ids, no overlap, no gap, and combinations as full as brute force finds."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from millrace.llm.slack_packing import cut_pieces, fullest, pack, plan, slots
from millrace.llm.token_ids import encode

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", "  ", "a \n b", "x  ", "  a", "trail  \n", "It's we'll  don't\t\tTAB\r\nx", "é ́x", "<|endoftext|> a", "\x1c\x1d a\x85 b", "a\xa0\n b", "日本語 テスト　全角", "ΑΣ ΣΑΣ.", None]


@pytest.mark.parametrize("name, spaces", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_ids_are_those_of_the_library(name, spaces):
    path = public_tokenizers.path(name)
    tool = Tokenizer.from_file(path)
    tool.encode_special_tokens = True
    ids, at = encode(pa.array(ODD), path, spaces)
    for i, text in enumerate(ODD):
        assert ids[at[i] : at[i + 1]].tolist() == tool.encode(text or "", add_special_tokens=False).ids + [0], repr(text)


def test_fullest_matches_all_subsets():
    rng = random.Random(2)
    for _ in range(200):
        lengths = [rng.randint(1, 30) for _ in range(rng.randint(0, 8))]
        room = rng.randint(0, 60)
        best = max(sum(s) for k in range(len(lengths) + 1) for s in itertools.combinations(lengths, k) if sum(s) <= room)
        chosen = fullest({n: lengths.count(n) for n in lengths}, room)
        assert sum(n * k for n, k in chosen.items()) == best
        assert all(k <= lengths.count(n) for n, k in chosen.items())


def test_plan_uses_every_piece_once():
    counts = {n: random.Random(n).randint(1, 40) for n in range(1, 300, 7)}
    planned = plan(counts, 300)
    for n, c in counts.items():
        assert sum(chosen.get(n, 0) * times for chosen, times in planned) == c
    assert all(sum(n * k for n, k in chosen.items()) <= 300 for chosen, _ in planned)
    assert len(slots(planned)) < 20 * len(counts)


def test_pieces_fill_sequences_without_gaps(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["cat", "dogs", "running"]) for _ in range(rng.choice([3, 40, 700, 5000])))) for i in range(60)]
    rows += [(60, None), (61, ""), (None, "cat"), (5, rows[5][1]), (5, rows[5][1])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, offset string").repartition(4)
    packed = pack(cut_pieces(df, PATH)).toPandas()
    assert sorted(packed.columns) == sorted(["doc_id", "text", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"])
    assert packed["length"].sum() == len(encode(pa.array([r[1] for r in rows]), PATH, False)[0])
    for _, group in packed.sort_values("offset").groupby("sequence_id"):
        assert group["offset"].tolist() == (np.cumsum(group["length"]) - group["length"]).tolist()
        assert group["length"].sum() <= 2048
    room: list[int] = []  # first fit, the longest first
    for n in sorted(packed["length"], reverse=True):
        at = next((i for i, r in enumerate(room) if r >= n), None)
        if at is None:
            room.append(2048)
        room[-1 if at is None else at] -= n
    assert packed["sequence_id"].nunique() <= len(room)
    for r in packed.itertuples():
        assert zlib.crc32(np.array(r.ids, "<u4")) == r.ids_crc32
        assert r.length == len(r.ids)
        assert r.start == 2048 * r.piece
    assert pack(cut_pieces(df.limit(0), PATH)).count() == 0


def test_repeated_rows_and_missing_pieces(spark):
    """One row makes up half the table; its pieces stay where they were cut. Taking pieces away leaves no gaps."""
    rows = [(1, "cat dog " * 300)] * 400 + [(i, "running " * (i % 50 + 1)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    pieces = cut_pieces(df, PATH, with_ids=False)
    for given in (pieces, pieces.filter("doc_id % 3 <> 0"), pieces.drop("_part", "_nth")):
        packed = pack(given).toPandas()
        assert len(packed) == given.count() and "_nth" not in packed.columns
        for _, group in packed.sort_values("offset").groupby("sequence_id"):
            assert group["offset"].tolist() == (np.cumsum(group["length"]) - group["length"]).tolist()
            assert group["length"].sum() <= 2048
        assert packed["sequence_id"].nunique() <= max((packed["length"] == 601).sum() / 3, packed["length"].sum() / 2048) * 1.02 + 1  # three of 601 fit
    plan_text = pack(pieces)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan_text
