import random

import pytest

from conftest import rows
from millrace.operators.overlap import overlap_sums, similar_pairs, split_prefixes
from millrace.operators.similarity import item_cosine
from test_similarity import brute, make


@pytest.mark.parametrize("min_pairs", [1, 2, 3, 6])
@pytest.mark.parametrize("block", [4096, 4])
def test_overlap_matches_brute_force(spark, min_pairs, block):
    data, df = make(spark, seed=min_pairs)
    got = {(r["item1"], r["item2"]): (r["xy"], r["xx"], r["yy"], r["n_pairs"]) for r in overlap_sums(df, min_pairs, block).collect()}
    assert got == brute(data, min_pairs)


@pytest.mark.parametrize("wide", [0, 20, 48])
def test_hot_users_by_any_width(spark, wide):
    for min_pairs in (1, 2, 3, 6):
        data, df = make(spark, seed=min_pairs)
        got = {(r["item1"], r["item2"]): (r["xy"], r["xx"], r["yy"], r["n_pairs"]) for r in overlap_sums(df, min_pairs, 7, wide).collect()}
        assert got == brute(data, min_pairs)


def test_thresholds_agree_with_all_pairs(spark):
    _, df = make(spark, seed=9)
    expect = [r for r in rows(item_cosine(df, min_pairs=3)) if r[2] > 0.9]
    assert expect and rows(similar_pairs(df, 0.9, 3)) == expect


def formed(df):
    return sum(n * (n - 1) // 2 for (n,) in df.groupBy("user_id").count().select("count").collect())


def test_hot_users_form_few_pairs(spark):
    """Three users hold most rows; behind the prefixes their items are never paired."""
    rng = random.Random(2)
    data = [(u, i, rng.randint(1, 5)) for u in range(3) for i in range(400)]
    data += [(u, i, rng.randint(1, 5)) for u in range(3, 300) for i in rng.sample(range(400), 3)]
    df = spark.createDataFrame(data, "user_id int, item_id int, rating int")
    prefix, rest = split_prefixes(df, 4)
    assert prefix.count() + rest.count() <= len(data)
    assert formed(prefix) * 100 < formed(df)
    got = {(r["item1"], r["item2"]): (r["xy"], r["xx"], r["yy"], r["n_pairs"]) for r in overlap_sums(df, 4).collect()}
    assert got and got == brute(data, 4)


def test_nulls_and_empty(spark):
    schema = "user_id int, item_id int, rating int"
    assert overlap_sums(spark.createDataFrame([], schema), 2).collect() == []
    some = [(1, 1, 2), (1, 2, 3), (2, 1, 4), (2, 2, 5), (None, 1, 1), (None, 2, 1), (3, None, 1), (3, 1, None), (3, 2, 2)]
    assert rows(overlap_sums(spark.createDataFrame(some, schema), 2)) == [(1, 2, 26, 20, 34, 2)]
