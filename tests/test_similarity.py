import math
import random
import re
from collections import defaultdict
from itertools import combinations

import pytest

from conftest import rows
from millrace.operators import similarity
from millrace.operators.similarity import co_rated_sums, item_cosine, nearest_vectors, similar_items


def make(spark, seed=1):
    """One user rated every item and two rated most; the others rated a few."""
    rng = random.Random(seed)
    data = [(0, i, rng.randint(1, 5)) for i in range(60)]
    data += [(1, i, rng.randint(1, 5)) for i in range(50)]
    data += [(2, i, rng.randint(1, 5)) for i in range(10, 55)]
    for u in range(3, 40):
        data += [(u, i, rng.randint(1, 5)) for i in rng.sample(range(60), rng.randint(1, 9))]
    return data, spark.createDataFrame(data, "user_id int, item_id int, rating int")


def brute(data, min_pairs):
    per_user = defaultdict(dict)
    for u, i, r in data:
        per_user[u][i] = r
    acc = defaultdict(list)
    for items in per_user.values():
        for a, b in combinations(sorted(items), 2):
            acc[a, b].append((items[a], items[b]))
    return {
        p: (sum(x * y for x, y in v), sum(x * x for x, _ in v), sum(y * y for _, y in v), len(v))
        for p, v in acc.items()
        if len(v) >= min_pairs
    }


@pytest.mark.parametrize("min_pairs", [1, 2, 3, 6])
@pytest.mark.parametrize("limits", [{}, {"block": 7}, {"heavy_rows": 20}, {"block": 4, "heavy_rows": 20}, {"block": 3, "heavy_rows": 0}])
def test_all_paths_match_brute_force(spark, min_pairs, limits):
    data, df = make(spark)
    got = {(r["item1"], r["item2"]): (r["xy"], r["xx"], r["yy"], r["n_pairs"]) for r in co_rated_sums(df, min_pairs, **limits).collect()}
    assert got == brute(data, min_pairs)


@pytest.mark.parametrize("limits", [{"dense": 1e9}, {"dense": 0}, {"dense": 1e9, "block": 4}, {"dense": 1e9, "hot_rows": 5}, {"dense": 1e9, "block": 3, "hot_rows": 9, "per_task": 50, "heavy_rows": 20}])
def test_stripes_match_brute_force(spark, limits):
    data, df = make(spark, seed=5)
    for min_pairs in (1, 3):
        got = {(r["item1"], r["item2"]): (r["xy"], r["xx"], r["yy"], r["n_pairs"]) for r in co_rated_sums(df, min_pairs, **limits).collect()}
        assert got == brute(data, min_pairs)


def test_rare_pairs_do_not_travel_as_rows(spark):
    """Most pairs meet once: behind the shuffle of lists there is no exchange of pairs, and tasks follow their number."""
    rng = random.Random(4)
    data = [(u, i, rng.randint(1, 5)) for u in range(300) for i in rng.sample(range(3000), 12)]
    df = spark.createDataFrame(data, "user_id int, item_id int, rating int")
    sums = co_rated_sums(df, 2, per_task=1000)
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(item1" in plan and not re.search(r"hashpartitioning\(item1#\d+, item2", plan)
    assert sums.rdd.getNumPartitions() >= 8
    got = {(r["item1"], r["item2"]): (r["xy"], r["xx"], r["yy"], r["n_pairs"]) for r in sums.collect()}
    assert got == brute(data, 2)


def test_cosine_hand_cases(spark):
    df = spark.createDataFrame(
        [(1, 1, 1), (1, 2, 1), (2, 1, 2), (2, 2, 2), (3, 3, 4), (3, 4, 2), (4, 5, 0), (4, 6, 3)], "user_id int, item_id int, rating int"
    )
    assert rows(item_cosine(df)) == [(1, 2, 1.0, 2), (3, 4, 1.0, 1), (5, 6, None, 1)]


def test_similar_items_agree_with_all_pairs(spark):
    data, df = make(spark)
    names = spark.createDataFrame([(i, f"item {i}") for i in range(60)], "id int, name string")
    pairs = item_cosine(df, min_pairs=3).collect()
    for item in (0, 30):
        near = [(r["item2"] if r["item1"] == item else r["item1"], r["score"], r["n_pairs"]) for r in pairs if item in (r["item1"], r["item2"])]
        expect = sorted((n for n in near if n[1] > 0.8), key=lambda n: (-n[1], -n[2], n[0]))[:10]
        got = similar_items(df, names, item, k=10, min_score=0.8, min_pairs=3)
        assert sorted(rows(got)) == sorted((i, s, n, f"item {i}") for i, s, n in expect)


def test_nearest_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 1.0]), (4, [0.0, 0.0])], "id int, v array<double>")
    got = [tuple(r) for r in nearest_vectors(df, "id", "v", 1, k=4).collect()]
    assert got == [(1, 1.0), (2, 1.0), (3, round(1 / math.sqrt(2), 6)), (4, None)]


@pytest.mark.parametrize("limits", [{}, {"hot_rows": 5}, {"block": 3, "heavy_rows": 20}])
def test_pairs_in_waves_match_brute_force(spark, limits, monkeypatch):
    """Lists of pairs come in waves, each stored before the next is formed."""
    stored, keep = [], similarity.materialize
    monkeypatch.setattr(similarity, "materialize", lambda df, label="stage": stored.append(label) or keep(df, label))
    data, df = make(spark, seed=5)
    got = {(r["item1"], r["item2"]): (r["xy"], r["xx"], r["yy"], r["n_pairs"]) for r in co_rated_sums(df, 3, dense=1e9, wave_pairs=1, **limits).collect()}
    assert got == brute(data, 3)
    assert stored.count("pair_sums") > 2 - bool(limits.get("heavy_rows"))
