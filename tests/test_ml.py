import random

import pytest
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RankingEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SF, rows
from millrace.ml import evaluate, features, recommend, selection
from millrace.ml.estimators import ESTIMATORS, estimator
from millrace.ml.preparation import Preparation
from millrace.plans import derived, similarity
from millrace.plans.catalog import all_queries
from millrace.storage import scratch_path


def test_regression_metrics_match_the_library(tables):
    df = derived.predicted_prices(tables)
    mine = evaluate.regression_metrics(df, digits=4).first().asDict()
    for name, metric in (("mse", "mse"), ("rmse", "rmse"), ("mae", "mae"), ("r2", "r2"), ("explained_variance", "var")):
        library = RegressionEvaluator(metricName=metric).evaluate(df)
        assert mine[name] == pytest.approx(library, rel=1e-4, abs=1e-3)


def test_class_metrics_match_the_library(tables):
    df = derived.predicted_classes(tables)
    mine = evaluate.multiclass_metrics(df).first().asDict()
    for name, metric in (("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"), ("weighted_recall", "weightedRecall"), ("f1", "f1")):
        assert mine[name] == pytest.approx(MulticlassClassificationEvaluator(metricName=metric).evaluate(df), abs=1e-6)
    for r in evaluate.rates_by_label(evaluate.confusion(df)).collect():
        for name, metric in (("precision", "precisionByLabel"), ("tpr", "truePositiveRateByLabel"), ("fpr", "falsePositiveRateByLabel")):
            library = MulticlassClassificationEvaluator(metricName=metric, metricLabel=r["class"]).evaluate(df)
            assert r[name] == pytest.approx(library, abs=1e-6)
    wrong = evaluate.error_rate(df).first()["error_pct"]
    assert wrong == pytest.approx(100 * (1 - mine["accuracy"]), abs=1e-3)


def test_curve_areas_match_the_library(tables):
    df = derived.scored_lines(tables)
    areas = evaluate.curve_areas(evaluate.score_curve(df)).first()
    for name, metric in (("area_roc", "areaUnderROC"), ("area_pr", "areaUnderPR")):
        library = BinaryClassificationEvaluator(rawPredictionCol="score", metricName=metric, numBins=0).evaluate(df)
        assert areas[name] == pytest.approx(library, abs=1e-6)
    merged = evaluate.score_curve(df, bins=15)
    library = BinaryClassificationEvaluator(rawPredictionCol="score", metricName="areaUnderROC", numBins=15).evaluate(df)
    assert evaluate.curve_areas(merged).first()["area_roc"] == pytest.approx(library, abs=1e-6)
    points = rows(evaluate.roc_points(merged).select("fpr", "tpr"))
    assert len(points) >= 15 and points[-1] == (1.0, 1.0)
    assert all(a[1] <= b[1] for a, b in zip(points, points[1:]))


def test_average_precision_by_hand(spark):
    ranked = spark.createDataFrame([(1, 1, 1), (1, 2, 2), (1, 3, 3), (2, 9, 1)], "user_id int, item_id int, rank int")
    actual = spark.createDataFrame([(1, 1), (1, 3)], "user_id int, item_id int")
    assert rows(evaluate.average_precision(ranked, actual, 3, 4)) == [(1, 2, 2, 0.8333), (2, 0, 0, 1.0)]
    assert rows(evaluate.average_precision(ranked, actual, 2, 4))[0] == (1, 2, 1, 0.5)
    got = {r["k"]: (r["users"], r["map"]) for r in evaluate.map_at_k(ranked, actual, [2, 3]).collect()}
    assert got == {2: (2, 0.25), 3: (2, pytest.approx(0.8333 / 2, abs=1e-4))}


def test_map_matches_the_library_where_lists_are_long(tables):
    """With k above every list length, both divide by the number of liked items."""
    ranked, liked = derived.lists(tables)
    mine = evaluate.average_precision(ranked, liked, 500).filter("n_actual > 0").agg(F.avg("ap")).first()[0]
    lists = ranked.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("rank", "item_id"))).alias("p"))
    lists = lists.select("user_id", F.transform("p", lambda s: s["item_id"].cast("double")).alias("prediction"))
    truth = liked.groupBy("user_id").agg(F.collect_list(F.col("item_id").cast("double")).alias("label"))
    library = RankingEvaluator(metricName="meanAveragePrecision").evaluate(lists.join(truth, "user_id"))
    assert mine == pytest.approx(library, abs=1e-5)


def test_codes_are_fitted_once(spark):
    train = spark.createDataFrame([("a", "yes"), ("a", "no"), ("b", "yes"), ("c", "no")], "c string, y string")
    test = spark.createDataFrame([("z", "no"), ("b", "yes"), ("b", "yes"), ("b", "no")], "c string, y string")
    _, (seen, scored) = features.fit_transform(features.category_pipeline(["c"], "y"), train, test)
    codes = dict(rows(seen.select("c", "c_idx").distinct()))
    assert codes == {"a": 0.0, "b": 1.0, "c": 2.0}
    assert dict(rows(scored.select("c", "c_idx").distinct())) == {"b": 1.0, "z": 3.0}
    assert dict(rows(seen.select("y", "label").distinct())) == {"yes": 0.0, "no": 1.0}


def test_preparation_uses_training_limits_modes_and_codes(spark):
    train = spark.createDataFrame(
        [(float(i), "a" if i % 3 else "?", "y" if i % 2 else "n") for i in range(1, 101)], "x double, c string, y string"
    )
    prepared = Preparation.fit(train, {"x": [0, 10, 50, 100]}, ["c"], "y")
    assert prepared.limits == {"x": (5.0, 95.0)} and prepared.replacements == {"c": "a"}
    new = spark.createDataFrame([(1e6, "?", "y"), (-3.0, "z", "n")], "x double, c string, y string")
    got = prepared.transform(new).select("x", "c", "x_bin", vector_to_array("features").alias("f"))
    # bins by size in training: 10-50 (40), 50-100 (50) first; the unseen category has its own code
    assert [tuple(r) for r in got.collect()] == [(95.0, "a", "50-100", [0.0, 0.0]), (5.0, "z", "0-10", [1.0, 2.0])]


def test_scalers(spark):
    df = features.assembler(["x"]).transform(spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double"))
    scaled = features.min_max().fit(df).transform(df).select(vector_to_array("scaled")[0])
    assert rows(scaled) == [(0.0,), (0.5,), (1.0,)]
    centred = features.standard(centre=True).fit(df).transform(df).select(vector_to_array("scaled")[0])
    assert rows(centred) == [(-1.0,), (0.0,), (1.0,)]


def line_rows(spark):
    df = spark.range(400).select("id", (F.col("id") % 20).cast("double").alias("x"))
    return features.assembler(["x"]).transform(df.withColumn("label", 3.0 * F.col("x") + 2.0))


def test_every_regressor_beats_the_mean(spark):
    df = line_rows(spark)
    for name in (n for n in ESTIMATORS if n.endswith("_reg") or n == "linear_regression"):
        model = estimator(name, **({"seed": 1} if name != "linear_regression" else {})).fit(df)
        assert evaluate.regression_metrics(model.transform(df)).first()["r2"] > 0.9


def test_search_refit_save_and_load(spark):
    df = line_rows(spark)
    est = estimator("linear_regression")
    maps = selection.grid(est, {"regParam": [0.0, 100.0]})
    rmse = RegressionEvaluator(metricName="rmse")
    best, params, table = selection.cross_validate(est, maps, rmse, df, "id")
    assert params[est.regParam] == 0.0 and table.count() == 2
    assert selection.train_validation(est, maps, rmse, df)[1] == params
    again = selection.refit(est, params, df)
    assert again.coefficients[0] == pytest.approx(3.0)
    path = selection.save(selection.as_pipeline(again), scratch_path(spark, "m"))
    from pyspark.ml import PipelineModel

    loaded = PipelineModel.load(path).transform(df)
    assert loaded.select("id", "prediction").exceptAll(again.transform(df).select("id", "prediction")).count() == 0
    names = {r["name"] for r in selection.inspect(spark, best).collect()}
    assert {"class", "regParam", "maxIter"} <= names


def test_compare_picks_the_lowest_error(spark):
    df = line_rows(spark)
    winner, models, table = selection.compare(
        {"flat": estimator("linear_regression", regParam=1e6), "line": estimator("linear_regression")}, RegressionEvaluator(metricName="rmse"), df, df
    )
    assert winner == "line" and set(models) == {"flat", "line"} and table.count() == 2


def test_recommendations(spark):
    data = [(u, i, 5.0 if (u % 2) == (i % 2) else 1.0) for u in range(12) for i in range(12) if (u * 7 + i) % 4]
    df = spark.createDataFrame(data, "user_id int, item_id int, rating float")
    model = recommend.als(rank=2, iterations=8, reg=0.05).fit(df)
    names = spark.createDataFrame([(i, f"i{i}") for i in range(12)], "id int, name string")
    rated = {(u, i) for u, i, _ in data}
    pairs = recommend.neighbour_candidates(df)
    found = {tuple(r) for r in pairs.collect()}
    assert found and not found & rated
    everything = spark.createDataFrame([(u, i) for u in range(12) for i in range(12)], "user_id int, item_id int")
    top = recommend.recommend_items(model, everything, 4, names)
    assert top.count() == 48
    assert top.filter("rank = 1 AND item_id % 2 != user_id % 2").count() == 0
    scores = {(r.user_id, r.item_id): r.score for r in recommend.score_pairs(model, everything).collect()}
    assert all(abs(scores[r.user_id, r.item_id] - r.prediction) < 1e-4 for r in model.transform(df).collect())
    assert recommend.recommend_users(model, everything, 2).count() == 24
    assert "CartesianProduct" not in recommend.recommend_items(model, pairs, 4)._jdf.queryExecution().executedPlan().toString()
    near = [r["id"] for r in recommend.similar_factors(model, 4, k=3).collect()]
    assert near[0] == 4 and all(i % 2 == 0 for i in near)


def test_ids_of_any_type_become_dense(spark):
    data = [("ann", 5_000_000_000, 3), ("bob", 7, 4), ("ann", 7, 5)]
    df = spark.createDataFrame(data, "user_id string, item_id bigint, rating int")
    users, items = recommend.dense_ids(df, "user_id"), recommend.dense_ids(df, "item_id")
    assert rows(users) == [("ann", 0), ("bob", 1)]
    assert rows(items) == [(7, 0), (5_000_000_000, 1)]
    assert rows(recommend.with_dense_ids(df, users, items)) == [(0, 0, 5.0), (0, 1, 3.0), (1, 0, 4.0)]


def best_by_hand(queries, data, k):
    out = set()
    for q, u in queries.items():
        scores = {}
        for d, v in data.items():
            scores[d] = 0.0
            for x, y in zip(u, v):
                scores[d] += x * y
        for rank, d in enumerate(sorted(scores, key=lambda d: (-scores[d], d))[:k], 1):
            out.add((q, d, rank, scores[d]))
    return out


@pytest.mark.parametrize("block", [3, 7, 64, 4096])
def test_best_products_match_brute_force(spark, block):
    rng = random.Random(3)
    vectors = [[i, [round(rng.gauss(0, 1) * 2 ** rng.randint(-3, 3), 2) for _ in range(4)]] for i in range(150)]
    vectors += [[150 + i, vectors[i % 3][1]] for i in range(9)] + [[160, [0.0] * 4]]
    queries = dict(vectors[:20]) | {200: [0.0] * 4, 201: [-v for v in vectors[0][1]]}
    ask = spark.createDataFrame(list(queries.items()), "id int, features array<double>")
    data = spark.createDataFrame(vectors, "id int, features array<double>")
    got = {tuple(r) for r in recommend.best_products(ask, data, 5, block).select("id", "other", "rank", "score").collect()}
    assert got == best_by_hand(queries, dict(vectors), 5)


def test_search_raises_floors_from_block_to_block():
    """A query block gives its best rows once, however many data blocks it meets."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(5)
    own, theirs = rng.normal(size=(30, 4)), rng.normal(size=(400, 4))
    parts = [slice(a, a + 40) for a in range(0, 400, 40)]
    cells = [{"_group": 0, "_ids": list(range(30)), "_vectors": own.ravel().tolist(), "_floors": [float("-inf")] * 30, "_others": list(range(400))[p], "_theirs": theirs[p].ravel().tolist()} for p in parts]
    found = [b for b in recommend._search(5)(iter([pa.RecordBatch.from_pylist([c]) for c in cells]))]
    assert sum(b.num_rows for b in found) == 150
    want = best_by_hand({i: v.tolist() for i, v in enumerate(own)}, {i: v.tolist() for i, v in enumerate(theirs)}, 5)
    assert {(r["id"], r["other"], r["score"]) for b in found for r in b.to_pylist()} == {(q, d, s) for q, d, _, s in want}


@pytest.mark.parametrize("key", ["rec_topk", "rec_topk_users", "rec_topk_user_subset", "rec_topk_item_subset"])
def test_registered_recommendations_rank_everything(spark, tables, monkeypatch, key):
    fit, models = similarity._als, []
    monkeypatch.setattr(similarity, "_als", lambda rows: models.append(fit(rows)) or models[0])
    got = {(r.user_id, r.item_id, r["rank"], r.score) for r in all_queries()[key](spark, SF).collect()}
    known = derived.ratings(tables).select("user_id", "item_id").collect()
    users, items = sorted({r.user_id for r in known}), sorted({r.item_id for r in known})
    u = {users[r.id]: list(r.features) for r in models[0].userFactors.collect()}
    i = {items[r.id]: list(r.features) for r in models[0].itemFactors.collect()}
    if key in ("rec_topk", "rec_topk_user_subset"):
        chosen = {r[0] for r in tables.customer.filter("c_mktsegment = 'BUILDING'").select("c_custkey").collect()} if "subset" in key else set(u)
        want = best_by_hand({x: v for x, v in u.items() if x in chosen}, i, 10)
    else:
        chosen = {r[0] for r in tables.part.filter("p_size > 40").select("p_partkey").collect()} if "subset" in key else set(i)
        want = {(b, a, rank, score) for a, b, rank, score in best_by_hand({x: v for x, v in i.items() if x in chosen}, u, 10)}
    assert got == want and got


def test_map_counts_hits_below_the_tenth_place(spark, tables):
    """Against lists made by hand: all of a user's own items are ranked, not the first ten."""
    own, of_item = {}, {}
    for r in derived.ratings(tables).collect():
        own.setdefault(r.user_id, {})[r.item_id] = r.rating
        of_item.setdefault(r.item_id, []).append(r.rating)
    mean = {i: round(sum(v) / len(v), 6) for i, v in of_item.items()}
    assert max(len(v) for v in own.values()) > 20
    want = {}
    for k in (10, 500, 2000):
        total = 0.0
        for rated in own.values():
            hits, score, n_liked = 0, 0.0, sum(r >= 4 for r in rated.values())
            for rank, i in enumerate(sorted(rated, key=lambda i: (-mean[i], i))[:k], 1):
                if rated[i] >= 4:
                    hits += 1
                    score += hits / rank
            total += score / min(n_liked, k) if n_liked else 0.0
        want[k] = (len(own), pytest.approx(total / len(own), abs=2e-6))
    got = {r["k"]: (r["users"], r["map"]) for r in all_queries()["ev_map_at_k_deep"](spark, SF).collect()}
    assert got == want


def test_fits_get_tasks_of_bounded_size(spark):
    """A stored table in one file is spread over all cores, and over more tasks where rows are many."""
    from millrace.storage import materialize, spread

    stored = materialize(spark.range(3000).coalesce(1), "one_file")
    assert stored.rdd.getNumPartitions() == 1
    wide = spread(stored, "id", rows=100)
    assert wide.rdd.getNumPartitions() == 30 and wide.rdd.glom().map(len).max() < 200
    assert sorted(r[0] for r in wide.collect()) == list(range(3000))
    assert spread(stored, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
