"""Growing dictionaries, stored quantile sketches and one-scan parsing, by hand and against exact results."""

import random

from pyspark.sql import functions as F

from millrace.operators import dictionaries
from millrace.operators.sketches import merge_sketches, quantile_sketches, sketched_quantiles
from millrace.sources import text


def test_numbers_stay_and_go_on(spark, tmp_path):
    path = str(tmp_path / "d")
    first = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "k string")
    second = spark.createDataFrame([("c",), ("a",), ("Z",), ("c",)], "k string")
    one = [("a", 0, 1), ("b", 1, 1)]
    both = [*one, ("Z", 2, 2), ("c", 3, 2)]
    assert sorted(map(tuple, dictionaries.grow(first, "k", path, 1).collect()), key=lambda r: r[1]) == one
    for _ in range(2):  # a load that runs again gives the same
        book = dictionaries.grow(second, "k", path, 2)
        assert sorted(map(tuple, book.collect()), key=lambda r: r[1]) == both
    rows = spark.createDataFrame([("a", 1), ("c", 2), ("new", 3), ("new", 4), (None, 5)], "k string, v int")
    coded = dictionaries.encode(rows, "k", book)
    assert sorted((r.v, r.code) for r in coded.collect()) == [(1, 0), (2, 3), (3, None), (4, None), (5, None)]
    assert [tuple(r) for r in dictionaries.unseen(rows, "k", book).collect()] == [("new", 2)]


def test_a_dictionary_may_start_empty(spark, tmp_path):
    path = str(tmp_path / "d")
    assert dictionaries.grow(spark.createDataFrame([], "k long"), "k", path, 1).count() == 0
    book = dictionaries.grow(spark.createDataFrame([(7,), (5,)], "k long"), "k", path, 2)
    assert sorted(map(tuple, book.collect())) == [(5, 0, 2), (7, 1, 2)]


def test_merged_sketches_keep_their_rank(spark):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), rng.randrange(10), rng.lognormvariate(0, 2)) for _ in range(20_000)] + [("a", 1, None), ("b", 1, float("nan"))] + [("c", 1, 3.0)] * 500
    df = spark.createDataFrame(rows, "g string, shard int, x double").repartition(6)
    merged = merge_sketches(quantile_sketches(df, ["g", "shard"], "x"), ["g"])
    got = sketched_quantiles(merged, ["g"], [0.05, 0.25, 0.5, 0.99]).collect()
    assert len(got) == 12
    for r in got:
        own = [x for g, _, x in rows if g == r.g and x is not None and x == x]
        assert r.n == len(own)
        below, upto = sum(x < r.value for x in own) / r.n, sum(x <= r.value for x in own) / r.n
        assert below - 0.01 <= r.share <= upto + 0.01


def test_records_and_rejects_from_one_scan(spark, tmp_path):
    lines = spark.createDataFrame([("1::a",), ("x::b",), ("2::",), ("3",), (None,), ("::c",)], "value string")
    fields = [("id", "bigint"), ("name", "string")]
    for some in (lines, lines.limit(0), lines.filter(F.col("value") == "1::a")):
        records, rejects = text.store_parsed(some, str(tmp_path / "out"), fields, sep="::")
        want = text.parse_records(some, fields, sep="::")
        for got, plain in zip((records, rejects), want):
            assert got.columns == plain.columns
            assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
