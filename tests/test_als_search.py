import random

import pytest

from conftest import rows
from millrace.ml import als_search


def planted(spark, users=60, items=40):
    """Ratings of two tastes: a product of one factor each, with every item's mean near three."""
    rng = random.Random(3)
    u, i = [rng.choice((-1, 1)) for _ in range(users)], [rng.choice((-1, 1)) for _ in range(items)]
    data = [(a, b, 3.0 + 1.5 * u[a] * i[b] + rng.uniform(-0.1, 0.1)) for a in range(users) for b in range(items) if rng.random() < 0.6]
    data.append((users, 0, 3.0))  # one rating only: its user is cold in its fold
    return data, spark.createDataFrame(data, "user_id int, item_id int, rating float")


def test_grid_finds_the_planted_rank(spark):
    data, df = planted(spark)
    model, best, table = als_search.search(df, [(1, 5.0), (3, 0.05)], iterations=8)
    got = {(r["rank"], r["reg"]): r for r in table.collect()}
    assert best == (3, 0.05) and model.rank == 3
    assert [k for k, r in got.items() if r["chosen"]] == [best]
    assert got[best]["rmse"] == min(r["rmse"] for r in got.values())
    assert got[best]["rmse"] < als_search.item_mean_rmse(df)
    assert all(r["n_scored"] + r["n_dropped"] == len(data) and r["n_dropped"] == 1 for r in got.values())


def test_folds_do_not_depend_on_partitions(spark):
    _, df = planted(spark)
    assert rows(als_search.with_folds(df, 2)) == rows(als_search.with_folds(df.repartition(7), 2))


def test_all_cold_is_refused(spark):
    df = spark.createDataFrame([(k, k, 1.0) for k in range(8)], "user_id int, item_id int, rating float")
    with pytest.raises(ValueError):
        als_search.search(df, [(1, 0.1)], iterations=1)
