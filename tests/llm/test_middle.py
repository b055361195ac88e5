"""Fill-in-the-middle: containers against plain lists, cuts against a regular expression, exact round trips."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import query_middle
from millrace.llm.boundary_set import ArrayContainer, BitmapContainer, BoundarySet, RunContainer
from millrace.llm.fill_middle import Markers, restored, transform
from millrace.session import Tables


def expected(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    digest = hashlib.sha256(f"1:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize(
    "offsets, kinds",
    [
        ([0], [ArrayContainer]),
        (range(0, 9000, 3), [ArrayContainer]),
        (range(0, 65536, 2), [BitmapContainer]),
        (range(100, 60000), [RunContainer]),
        ([*range(0, 65536, 5), *range(65536, 131072), 400_000, 400_007], [BitmapContainer, RunContainer, ArrayContainer]),
    ],
)
def test_select_finds_every_offset(offsets, kinds):
    offsets = list(offsets)
    found = BoundarySet(np.array(offsets))
    assert [type(c) for c in found.containers] == kinds and len(found) == len(offsets)
    some = range(0, len(offsets), max(1, len(offsets) // 3000))
    assert [found.select(k) for k in [*some, len(offsets) - 1]] == [offsets[k] for k in [*some, len(offsets) - 1]]
    with pytest.raises(IndexError):
        found.select(len(offsets))


def test_random_sets():
    rng = random.Random(3)
    for _ in range(60):
        offsets = sorted(rng.sample(range(rng.choice([50, 70_000, 300_000])), rng.randint(1, 50)))
        offsets = sorted({o + i for o in offsets for i in range(rng.choice([1, 2, 4000]))})
        found = BoundarySet(np.array(offsets))
        ks = rng.sample(range(len(offsets)), min(200, len(offsets)))
        assert [found.select(k) for k in ks] == [offsets[k] for k in ks]


def test_rows_match_the_pattern_and_turn_back(spark):
    rng = random.Random(5)
    signs = ["a", "Zq", "é", "日", "🙂", " ", "\n", "<", ">", "P", "<S", "7", "\x00", "ſ"]
    rows = [(i, "".join(rng.choices(signs, k=rng.randint(0, 40))), i, "x") for i in range(300)]
    rows += [(300, None, 1, None), (301, "", 1, None), (None, "one two", 1, None), (7, rows[7][1], 7, "x"), (302, "a <P> b", 1, "y"), (303, "<M>", 1, "y")]
    rows += [(i, ("word 日本 " * 30_000 if i % 2 else "...,," * 40_000) + "end", 1, "long") for i in range(310, 318)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int, `a.b` string").repartition(3)
    cut = transform(df)
    assert cut.columns == ["doc_id", "text", "a.b", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = cut.withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == expected(r["doc_id"], r["text"])
        assert r["back"] == (r["text"] or "")
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert transform(df.limit(0)).count() == 0


def test_other_markers_turn_back(spark):
    df = spark.createDataFrame([(i, f"some text {i} of <P>") for i in range(50)], "doc_id long, text string")
    markers = Markers("[pre]", "[suf]", "[mid]")
    got = transform(df, markers=markers, plain_percent=0, spm_percent=50)
    assert got.filter("form = 'plain'").count() == 0
    assert got.filter(restored(F.col("output"), F.col("form"), markers) != F.col("text")).count() == 0
    for bad in (("", "b", "c"), ("ab", "bc", "d"), ("x", "x", "y"), ("aba", "c", "d"), ("<P>", "<P>x", "y")):
        with pytest.raises(ValueError):
            Markers(*bad)


def test_query_matches_sql(spark):
    folder = "/root/testdata/sf0.001"
    got = sorted(tuple(r) for r in query_middle.op11_fill_middle(Tables(spark, folder)).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    assert got == sorted(con.execute(query_middle.SQL).fetchall())
