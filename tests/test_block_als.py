import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace.ml import als_search, block_als, recommend
from millrace.storage import materialize, shared_root

REG = 0.05


def planted(spark):
    """30 x 20 ratings from three factors; user 7 and item 18 have none, item 25 a single one, one pair comes twice."""
    rng = np.random.default_rng(0)
    u, v = rng.standard_normal((30, 3)), rng.standard_normal((20, 3))
    got = [(i, j, float(np.float32(u[i] @ v[j]))) for i in range(30) for j in range(20) if rng.random() < 0.6 and i != 7 and j != 18]
    got += [(3, 25, 1.0), got[0]]
    return got, spark.createDataFrame(got, "user_id int, item_id int, rating double").repartition(3)


def test_each_side_solves_its_normal_equations(spark):
    got, df = planted(spark)
    blocks = block_als.Blocks(df, block_rows=40)
    try:
        model = blocks.fit(rank=3, iterations=2, reg=REG, cold="nan")
        again = blocks.fit(rank=3, iterations=2, reg=REG)
    finally:
        blocks.release()
    assert blocks._blocks > 8
    users, items = ({r["id"]: np.array(r["features"]) for r in f.collect()} for f in (model.userFactors, model.itemFactors))
    assert set(users) == {r[0] for r in got} and set(items) == {r[1] for r in got}
    for user, vector in users.items():
        mine = [(items[j], r) for i, j, r in got if i == user]
        x, y = np.array([m[0] for m in mine]), np.array([m[1] for m in mine])
        assert np.allclose(vector, np.linalg.solve(x.T @ x + REG * len(mine) * np.eye(3), x.T @ y), atol=1e-4)
    assert rows(again.userFactors) == rows(model.userFactors)

    asked = spark.createDataFrame([(1, 2, "a"), (7, 2, "b"), (1, 18, "c"), (99, 2, "d"), (None, 2, "e"), (-1, 2, "f")], "user_id int, item_id int, tag string")
    scored = {r["tag"]: r["prediction"] for r in model.transform(asked).collect()}
    assert scored["a"] == pytest.approx(float(users[1] @ items[2]), abs=1e-4)
    assert len(scored) == 6 and all(np.isnan(scored[t]) for t in "bcdef")
    assert [r["tag"] for r in again.transform(asked).collect()] == ["a"]


def test_an_id_with_many_rows_is_solved_in_parts(monkeypatch):
    rng = np.random.default_rng(1)
    x, y, counts = rng.standard_normal((60, 3)).astype(np.float32), rng.standard_normal(60).astype(np.float32), np.array([5, 40, 1, 2, 12])
    whole = block_als.normal_solutions(x, y, counts, 0.1)
    monkeypatch.setattr(block_als, "_SLICE", 8)
    assert np.allclose(block_als.normal_solutions(x, y, counts, 0.1), whole, atol=1e-5)
    # Without a penalty an id with fewer ratings than factors has no single solution.
    assert np.isfinite(block_als.normal_solutions(x, y, counts, 0.0)).all()


def test_null_ratings_are_refused(spark):
    df = spark.createDataFrame([(0, 0, 1.0), (1, 1, None)], "user_id int, item_id int, rating double")
    with pytest.raises(Exception, match="null or NaN"):
        block_als.Blocks(df)


def test_many_ratings_go_to_blocks_and_sparse_ids_do_not(spark):
    _, df = planted(spark)
    fits = recommend.Fits(df, most=100)
    model = fits.fit(3, 3, REG)
    fits.release()
    assert isinstance(model, block_als.FactorModel)
    error = F.avg((F.col("rating") - F.col("prediction")) ** 2)
    library = recommend.als(rank=3, iterations=3, reg=REG).fit(df)
    assert model.transform(df).agg(error).first()[0] < 2 * library.transform(df).agg(error).first()[0] + 0.05
    best = recommend.top_items(model, 4)
    assert best.groupBy("user_id").count().filter("count = 4").count() == 29
    assert not isinstance(recommend.Fits(df.withColumn("user_id", F.col("user_id") * 1000), most=100).fit(1, 1, REG), block_als.FactorModel)


def test_search_over_blocks(spark, monkeypatch):
    _, df = planted(spark)
    expected = [(r["rank"], r["n_scored"], r["n_dropped"]) for r in als_search.search(df, [(1, 5.0), (3, REG)], iterations=1)[2].collect()]
    monkeypatch.setattr(recommend.Fits.__init__, "__defaults__", (100,))
    model, best, table = als_search.search(df, [(1, 5.0), (3, REG)], iterations=1)
    found = table.collect()
    assert isinstance(model, block_als.FactorModel)
    assert [(r["rank"], r["n_scored"], r["n_dropped"]) for r in found] == expected
    assert [(r["rank"], r["reg"]) for r in found if r["rmse"] == min(r["rmse"] for r in found)] == [best]


def test_materialize_leaves_no_shuffle_behind(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    before, setting = manager.shuffleStatuses().size(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    stored = materialize(spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count(), "counted")
    assert manager.shuffleStatuses().size() <= before
    assert stored.count() == 7 and os.path.isdir(shared_root(spark))
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == setting
