"""Feature, estimator, selection and persistence queries."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from millrace.ml import curves, features, recommend, selection, trees
from millrace.ml.estimators import estimator
from millrace.ml.evaluate import regression_metrics, silhouette
from millrace.ml.preparation import Preparation
from millrace.ml.stages import census_cleaning
from millrace.operators.aggregates import contingency_long
from millrace.operators.sampling import hash_split
from millrace.plans import derived
from millrace.plans.catalog import query
from millrace.storage import materialize, scratch_path, spread

# --- features ---------------------------------------------------------------------------------


@query(
    "ml_string_index",
    """WITH f AS (SELECT o_orderpriority AS x, CAST(row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS INTEGER) AS i FROM orders GROUP BY 1)
    SELECT o_orderkey, i AS by_frequency, CAST(dense_rank() OVER (ORDER BY o_orderstatus DESC) - 1 AS INTEGER) AS by_name FROM orders JOIN f ON x = o_orderpriority""",
)
def _(t):
    by_count = features.indexer(["o_orderpriority"]).fit(t.orders)
    by_name = features.indexer(["o_orderstatus"], order="alphabetDesc").fit(t.orders)
    return by_name.transform(by_count.transform(t.orders)).select(
        "o_orderkey", F.col("o_orderpriority_idx").cast("int").alias("by_frequency"), F.col("o_orderstatus_idx").cast("int").alias("by_name")
    )


@query(
    "ml_one_hot",
    """WITH f AS (SELECT o_orderpriority AS x, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS i FROM orders GROUP BY 1)
    SELECT o_orderkey, """
    + ", ".join(f"CASE WHEN i = {i} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_{i}" for i in range(4))
    + " FROM orders JOIN f ON x = o_orderpriority",
)
def _(t):
    indexed = features.indexer(["o_orderpriority"], invalid="error").fit(t.orders).transform(t.orders)
    coded = features.one_hot(["o_orderpriority_idx"]).fit(indexed).transform(indexed)
    bits = vector_to_array("o_orderpriority_idx_vec")
    return coded.select("o_orderkey", *[bits[i].alias(f"is_{i}") for i in range(4)])


_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount"]


def _assembled(t):
    return features.assembler(_NUMBERS).transform(t.lineitem.select("l_orderkey", "l_linenumber", *_NUMBERS))


def _components(df, column):
    parts = vector_to_array(column)
    return df.select("l_orderkey", "l_linenumber", *[F.round(parts[i], 6).alias(f"f{i}") for i in range(3)])


@query(
    "ml_assemble",
    "SELECT l_orderkey, l_linenumber, " + ", ".join(f"round({c}, 6) AS f{i}" for i, c in enumerate(_NUMBERS)) + " FROM lineitem",
)
def _(t):
    return _components(_assembled(t), "features")


@query(
    "ml_minmax_scale",
    "SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"round(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()), 6) AS f{i}" for i, c in enumerate(_NUMBERS))
    + " FROM lineitem",
)
def _(t):
    rows = _assembled(t)
    return _components(features.min_max().fit(rows).transform(rows), "scaled")


@query(
    "ml_standard_scale",
    "WITH s AS (SELECT " + ", ".join(f"stddev_samp({c}) AS s{i}" for i, c in enumerate(_NUMBERS)) + " FROM lineitem) SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"round({c} / s{i}, 6) AS f{i}" for i, c in enumerate(_NUMBERS))
    + " FROM lineitem, s",
)
def _(t):
    rows = _assembled(t)
    return _components(features.standard().fit(rows).transform(rows), "scaled")


def _buyers(t):
    """Orders with customer attributes, marker values included, and a train/test number."""
    buyers = t.customer.select("c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey")
    joined = derived.marked_orders(t, "o_custkey").join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    label = F.when(F.col("status") == "F", "finished").otherwise("other")
    return hash_split(joined.withColumn("outcome", label), ["o_orderkey"], [0.7, 0.3])


_EDGES = {"o_totalprice": [0, 100000, 200000, 300000, 500000], "c_acctbal": [-1000, 0, 2500, 5000, 10000]}
_CODED = ["priority", "c_mktsegment", "o_totalprice_bin", "c_acctbal_bin"]


def _bin_sql(column: str) -> str:
    steps = zip(_EDGES[column], _EDGES[column][1:])
    return "CASE " + " ".join(f"WHEN {column} BETWEEN {a} AND {b} THEN '{a}-{b}'" for a, b in steps) + f" ELSE 'Out' END AS {column}_bin"


def _clip_sql(column: str) -> str:
    bound = f"(SELECT quantile_disc({column}, {{}}) FROM buyers WHERE split = 0)"
    return f"least(greatest({column}, {bound.format(0.05)}), {bound.format(0.95)}) AS {column}"


def _code_sql(column: str) -> str:
    return f"""{column}_codes AS (SELECT {column} AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS DOUBLE) AS code
    FROM binned WHERE split = 0 GROUP BY {column})"""


@query(
    "ml_census_features",
    f"""WITH {derived.MARKED},
    buyers AS (SELECT m.o_orderkey, m.o_totalprice, priority, c_acctbal, c_mktsegment, CASE WHEN status = 'F' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS done,
      CASE WHEN CAST(('0x' || substr(md5('|' || m.o_orderkey), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE < 0.7 THEN 0 ELSE 1 END AS split
      FROM marked m JOIN orders o ON m.o_orderkey = o.o_orderkey JOIN customer ON o_custkey = c_custkey),
    clipped AS (SELECT o_orderkey, split, done, c_mktsegment, CASE WHEN priority = '?' THEN
        (SELECT priority FROM buyers WHERE split = 0 AND priority <> '?' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) ELSE priority END AS priority,
      {_clip_sql("o_totalprice")}, {_clip_sql("c_acctbal")} FROM buyers),
    binned AS (SELECT o_orderkey, split, done, priority, c_mktsegment, {_bin_sql("o_totalprice")}, {_bin_sql("c_acctbal")} FROM clipped),
    """
    + ", ".join(_code_sql(c) for c in _CODED)
    + """ SELECT o_orderkey, split, done AS label, """
    + ", ".join(f"coalesce({c}_codes.code, (SELECT CAST(count(*) AS DOUBLE) FROM {c}_codes)) AS f{i}" for i, c in enumerate(_CODED))
    + " FROM binned "
    + " ".join(f"LEFT JOIN {c}_codes ON binned.{c} = {c}_codes.v" for c in _CODED),
)
def _(t):
    rows = materialize(_buyers(t), "buyers")
    prepared = Preparation.fit(rows.filter("split = 0"), _EDGES, ["priority", "c_mktsegment"], "outcome")
    parts = vector_to_array("features")
    return prepared.transform(rows).select("o_orderkey", "split", "label", *[parts[i].alias(f"f{i}") for i in range(4)])


# Numbers as wide as the census columns they stand for; a third of the classes is missing.
_CENSUS = {
    "age": "o_custkey % 104",
    "wage_per_hour": "o_orderkey % 10500",
    "capital_gains": "(o_orderkey * 7) % 101000",
    "capital_losses": "(o_custkey * 11) % 5200",
    "dividends_from_stocks": "(o_orderkey * 13) % 100100",
    "total_person_earnings": "(o_orderkey * 17 + o_custkey) % 100500",
    "num_persons_worked_for_employer": "o_orderkey % 12",
    "weeks_worked_in_year": "o_custkey % 57",
    "own_business_or_self_employed": "o_orderkey % 8",
}
_WORKER = "CASE WHEN o_orderkey % 3 = 0 THEN '?' ELSE o_orderpriority END"


def _census_bin_sql(column: str) -> str:
    edges = features.CENSUS_EDGES[column]
    labels = features.CENSUS_LABELS.get(column) or [f"{a}-{b}" for a, b in zip(edges, edges[1:])]
    steps = " ".join(f"WHEN {column} BETWEEN {a} AND {b} THEN '{label}'" for a, b, label in zip(edges, edges[1:], labels))
    return f"CASE {steps} ELSE '{features.CENSUS_DEFAULTS.get(column, 'Out')}' END AS {column}_bin"


@query(
    "ml_census_pipeline",
    f"""WITH people AS (SELECT o_orderkey, {", ".join(f"{v} AS {c}" for c, v in _CENSUS.items())}, {_WORKER} AS class_of_worker,
      CASE WHEN CAST(('0x' || substr(md5('|' || o_orderkey), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE < 0.7 THEN 0 ELSE 1 END AS split FROM orders),
    bounds AS (SELECT quantile_disc(total_person_earnings, 0.05) AS lo, quantile_disc(total_person_earnings, 0.95) AS hi FROM people WHERE split = 0),
    clean AS (SELECT * REPLACE (CAST(least(greatest(total_person_earnings, lo), hi) AS DOUBLE) AS total_person_earnings, CASE WHEN class_of_worker = '?' THEN
        (SELECT class_of_worker FROM people WHERE split = 0 AND class_of_worker <> '?' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) ELSE class_of_worker END AS class_of_worker)
      FROM people, bounds),
    codes AS (SELECT class_of_worker AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, class_of_worker) - 1 AS DOUBLE) AS code FROM clean WHERE split = 0 GROUP BY 1)
    SELECT o_orderkey, split, class_of_worker, code AS class_of_worker_idx, total_person_earnings, {", ".join(_census_bin_sql(c) for c in _CENSUS)}
    FROM clean LEFT JOIN codes ON class_of_worker = v""",
)
def _(t):
    """Cleaning and coding as one pipeline: fitted on training rows, saved, loaded, applied to all rows."""
    columns = [F.expr(v).alias(c) for c, v in _CENSUS.items()]
    people = hash_split(t.orders.select("o_orderkey", *columns, F.expr(_WORKER).alias("class_of_worker")), ["o_orderkey"], [0.7, 0.3])
    steps = [*census_cleaning(["class_of_worker"], ["total_person_earnings"]), features.indexer(["class_of_worker"])]
    path = selection.save(Pipeline(stages=steps).fit(people.filter("split = 0")), scratch_path(t.spark, "census"))
    kept = ["o_orderkey", "split", "class_of_worker", "class_of_worker_idx", "total_person_earnings", *[f"{c}_bin" for c in _CENSUS]]
    return PipelineModel.load(path).transform(people).select(*kept)


# --- estimators -------------------------------------------------------------------------------


def _prices(t):
    """Price regression rows (features, label), train and test, stored once."""
    numbers = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
    rows = hash_split(t.lineitem.select("l_orderkey", "l_partkey", F.col("l_extendedprice").alias("label"), *numbers), ["l_orderkey", "l_partkey"], [0.7, 0.3])
    data = materialize(features.assembler(numbers).transform(rows).select("l_orderkey", "l_partkey", "features", "label", "split"), "prices")
    return data.filter("split = 0").drop("split"), data.filter("split = 1").drop("split")


_U = "CAST(('0x' || substr(md5({}), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE"
_TEST_LINES = f"""SELECT count(*) AS n_rows, count(DISTINCT (l_orderkey, l_partkey)) AS n_keys, round(avg(l_extendedprice), 4) AS mean_label,
    true AS all_scored, true AS beats_mean FROM lineitem WHERE {_U.format("'|' || l_orderkey || '|' || l_partkey")} >= 0.7"""


def _regress(t, name, **params):
    train, test = _prices(t)
    model = estimator(name, **params).fit(spread(train, "l_orderkey", "l_partkey"))
    return model.transform(test).select("l_orderkey", "l_partkey", "label", "prediction")


def _regressed(t, name, **params):
    """What the predictions for the test rows come to; on the rows it learned from, the model must beat the label's mean."""
    train, test = _prices(t)
    model = estimator(name, **params).fit(spread(train, "l_orderkey", "l_partkey"))
    scored = materialize(model.transform(test).select("l_orderkey", "l_partkey", "label", "prediction"), "scored")
    fitted = model.transform(train).agg((F.avg((F.col("label") - F.col("prediction")) ** 2) < F.var_pop("label")).alias("beats_mean"))
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("l_orderkey", "l_partkey").alias("n_keys"), F.round(F.avg("label"), 4).alias("mean_label"),
        (F.count_if(F.col("prediction").isNull() | F.isnan("prediction")) == 0).alias("all_scored"),
    ).join(F.broadcast(fitted))


@query(
    "ml_linear_regression",
    "SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem",
)
def _(t):
    rows = features.assembler(["l_quantity"]).transform(t.lineitem.select("l_quantity", F.col("l_extendedprice").alias("label")))
    model = estimator("linear_regression", solver="normal").fit(rows)
    line = [(round(float(model.coefficients[0]), 4), round(float(model.intercept), 4))]
    return t.spark.createDataFrame(line, "slope double, intercept double")


@query("ml_linear_regression_elastic", _TEST_LINES)
def _(t):
    return _regressed(t, "linear_regression", regParam=0.1, elasticNetParam=0.5, maxIter=10, tol=1e-4)


@query("ml_decision_tree_reg", _TEST_LINES)
def _(t):
    return _regressed(t, "decision_tree_reg", maxDepth=4, maxBins=32, seed=1)


@query("ml_random_forest_reg", _TEST_LINES)
def _(t):
    return _regressed(t, "random_forest_reg", maxDepth=4, numTrees=10, seed=1)


@query("ml_gbt_reg", _TEST_LINES)
def _(t):
    return _regressed(t, "gbt_reg", maxDepth=3, maxIter=5, seed=1)


def _outcomes(t):
    """Binary classification rows (non-negative features, label), train and test, one fitted feature model."""
    rows = materialize(_buyers(t), "buyers")
    scaled = rows.withColumn("balance", F.col("c_acctbal") + 1000.0).withColumn("price", F.col("o_totalprice") / 1000.0)
    pipeline = features.category_pipeline(["priority", "c_mktsegment"], "outcome", ["balance", "price"])
    model, (train, test) = features.fit_transform(pipeline, scaled.filter("split = 0"), scaled.filter("split = 1"))
    keep = ["o_orderkey", "features", "label"]
    return model, scaled, spread(train.select(*keep), "o_orderkey"), test.select(*keep)


_TEST_ORDERS = f"""WITH {derived.MARKED} SELECT count(*) AS n_rows, count(DISTINCT m.o_orderkey) AS n_keys, count(*) FILTER (status = 'F') AS n_finished, true AS all_scored
    FROM marked m JOIN orders o ON m.o_orderkey = o.o_orderkey JOIN customer ON o_custkey = c_custkey WHERE {_U.format("'|' || m.o_orderkey")} >= 0.7"""


def _classified(t, scored):
    """What the predictions for the test rows come to: every row once, with one of the two classes."""
    names = _buyers(t).select(F.col("o_orderkey").alias("_k"), "outcome")
    joined = scored.select("o_orderkey", "prediction").join(names, F.col("o_orderkey") == F.col("_k"))
    return joined.agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("o_orderkey").alias("n_keys"), F.count_if(F.col("outcome") == "finished").alias("n_finished"),
        (F.count_if(~F.coalesce(F.col("prediction").isin(0.0, 1.0), F.lit(False))) == 0).alias("all_scored"),
    )


def _classify(t, name, **params):
    _, _, train, test = _outcomes(t)
    return _classified(t, estimator(name, **params).fit(train).transform(test))


@query("ml_logistic_regression", _TEST_ORDERS)
def _(t):
    return _classify(t, "logistic_regression", regParam=0.01, elasticNetParam=0.5, maxIter=10)


@query("ml_linear_svc", _TEST_ORDERS)
def _(t):
    return _classify(t, "linear_svc", regParam=0.1, maxIter=10)


@query("ml_decision_tree_clf", _TEST_ORDERS)
def _(t):
    return _classify(t, "decision_tree_clf", maxDepth=5, maxBins=50, seed=1)


@query("ml_random_forest_clf", _TEST_ORDERS)
def _(t):
    return _classify(t, "random_forest_clf", numTrees=140, maxDepth=10, maxBins=150, seed=1)


@query("ml_gbt_clf", _TEST_ORDERS)
def _(t):
    return _classify(t, "gbt_clf", maxDepth=3, maxIter=20, maxBins=50, seed=1)


@query("ml_naive_bayes", _TEST_ORDERS)
def _(t):
    return _classify(t, "naive_bayes", smoothing=1.0)


def _vectors(t):
    return t.embeddings.select("vec_id", F.col("label").alias("kind"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


def _clusters(t, k, **params):
    rows = _vectors(t)
    model = estimator("kmeans", k=k, maxIter=params.pop("maxIter", 20), tol=1e-4, distanceMeasure="cosine", seed=1).fit(rows)
    return model, model.transform(rows)


@query("ml_kmeans", "SELECT count(*) AS n_rows, count(DISTINCT vec_id) AS n_keys, CAST(5 AS BIGINT) AS n_clusters FROM embeddings")
def _(t):
    _, assigned = _clusters(t, 5, maxIter=500)
    return assigned.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("vec_id").alias("n_keys"), F.countDistinct("prediction").alias("n_clusters"))


@query("ml_kmeans_k_sweep", "SELECT CAST(unnest(range(2, 21)) AS INTEGER) AS k, (SELECT count(*) FROM embeddings) AS n_rows, true AS in_range")
def _(t):
    rows = _vectors(t).persist()
    scores = []
    try:
        for k in range(2, 21):
            assigned = KMeans(k=k, maxIter=500, seed=1, distanceMeasure="cosine").fit(rows).transform(rows)
            scores.append((k, assigned.count(), -1.0 <= float(silhouette(assigned, distance="cosine")) <= 1.0))
    finally:
        rows.unpersist()
    return t.spark.createDataFrame(scores, "k int, n_rows bigint, in_range boolean")


# --- cluster evaluation, selection, persistence -----------------------------------------------


@query(
    "ev_silhouette",
    """WITH flat AS (SELECT vec_id, label AS kind, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
    unit AS (SELECT vec_id, kind, i, v / sqrt(sum(v * v) OVER (PARTITION BY vec_id)) AS v FROM flat),
    centre AS (SELECT kind AS other, i, sum(v) AS y, count(*) AS n FROM unit GROUP BY 1, 2),
    dist AS (SELECT vec_id, kind, other, any_value(n) AS n, 1 - sum(v * y) / any_value(n) AS d FROM unit JOIN centre USING (i) GROUP BY 1, 2, 3),
    sides AS (SELECT vec_id, max(CASE WHEN kind = other THEN d * n / (n - 1) END) AS a, min(CASE WHEN kind <> other THEN d END) AS b FROM dist GROUP BY 1)
    SELECT label AS kind, count(*) AS n, (SELECT round(avg((b - a) / greatest(a, b)), 6) FROM sides) AS silhouette FROM embeddings GROUP BY label""",
)
def _(t):
    rows = _vectors(t).withColumn("prediction", F.col("kind"))
    value = round(float(silhouette(rows, distance="cosine")), 6)
    return rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).withColumn("silhouette", F.lit(value))


@query("ev_cluster_contingency", "SELECT CAST(label AS VARCHAR) AS kind, count(*) AS n FROM embeddings GROUP BY 1")
def _(t):
    _, assigned = _clusters(t, 5)
    table = contingency_long(assigned, [("kind", "prediction")])
    path = scratch_path(t.spark, "cluster-table")
    table.write.csv(path, header=True)
    cells = t.spark.read.schema(table.schema).csv(path, header=True)
    return cells.groupBy(F.col("left_value").alias("kind")).agg(F.sum("n").alias("n"))


def _rmse():
    return RegressionEvaluator(metricName="rmse")


def _auc():
    return BinaryClassificationEvaluator(rawPredictionCol="rawPrediction")


_SEARCH = "SELECT CAST({} AS BIGINT) AS candidates, true AS best_chosen"


def _searched(table, maps, chosen, least):
    """Candidates scored, and whether the one chosen has the best score."""
    best = F.min_by("candidate", "score") if least else F.max_by("candidate", "score")
    return table.agg(F.count_if(F.col("score").isNotNull()).alias("candidates"), (best == maps.index(chosen)).alias("best_chosen"))


@query("sel_cross_validate", _SEARCH.format(4))
def _(t):
    train, _ = _prices(t)
    est = estimator("linear_regression", maxIter=5)
    maps = selection.grid(est, {"regParam": [0.01, 0.1], "elasticNetParam": [0.0, 1.0]})
    _, chosen, table = selection.cross_validate(est, maps, _rmse(), train, "l_orderkey", folds=3)
    return _searched(table, maps, chosen, least=True)


@query("sel_train_validation", _SEARCH.format(3))
def _(t):
    _, _, train, _ = _outcomes(t)
    est = estimator("logistic_regression", maxIter=5)
    maps = selection.grid(est, {"regParam": [0.01, 0.1, 0.3]})
    _, chosen, table = selection.train_validation(est, maps, _auc(), train)
    return _searched(table, maps, chosen, least=False)


@query("sel_model_compare", "SELECT unnest(['linear_regression', 'decision_tree_reg', 'gbt_reg']) AS model, 'rmse' AS metric, true AS not_below_winner")
def _(t):
    train, test = _prices(t)
    candidates = {
        "linear_regression": estimator("linear_regression", maxIter=5),
        "decision_tree_reg": estimator("decision_tree_reg", maxDepth=3, seed=1),
        "gbt_reg": estimator("gbt_reg", maxDepth=3, maxIter=3, seed=1),
    }
    winner, models, table = selection.compare(candidates, _rmse(), spread(train, "l_orderkey", "l_partkey"), test)
    selection.save(models[winner], scratch_path(t.spark, "winner"))
    least = table.filter(F.col("model") == winner).select(F.col("value").alias("least"))
    return table.join(F.broadcast(least)).select("model", "metric", (F.col("value") >= F.col("least")).alias("not_below_winner"))


@query("sel_refit_best", _TEST_ORDERS)
def _(t):
    _, _, train, test = _outcomes(t)
    est = estimator("random_forest_clf", seed=1, maxBins=150)
    maps = selection.grid(est, {"maxDepth": [3, 5], "numTrees": [5]})
    _, best, _ = selection.cross_validate(est, maps, _auc(), train, "o_orderkey")
    return _classified(t, selection.refit(est, best, train).transform(test))


@query("mdl_save_load", _TEST_ORDERS.replace("true AS all_scored", "true AS all_scored, CAST(count(*) AS BIGINT) AS n_agree"))
def _(t):
    prepared, rows, train, _ = _outcomes(t)
    fitted = estimator("gbt_clf", maxDepth=3, maxIter=3, seed=1).fit(train)
    path = selection.save(selection.as_pipeline(prepared, fitted), scratch_path(t.spark, "model"))
    test = rows.filter("split = 1")
    loaded = materialize(PipelineModel.load(path).transform(test).select("o_orderkey", "prediction"), "loaded")
    direct = fitted.transform(prepared.transform(test)).select(F.col("o_orderkey").alias("_k"), F.col("prediction").alias("_p"))
    agree = loaded.join(direct, F.col("o_orderkey") == F.col("_k")).agg(F.count_if(F.col("prediction") == F.col("_p")).alias("n_agree"))
    return _classified(t, loaded).join(F.broadcast(agree))


@query("mdl_inspect")
def _(t):
    _, _, train, _ = _outcomes(t)
    tree = estimator("decision_tree_clf", maxDepth=3, maxBins=50, seed=1).fit(train)
    clusters, _ = _clusters(t, 3)
    r = derived.stored_ratings(t)
    rows = recommend.with_dense_ids(r, recommend.dense_ids(r, "user_id"), recommend.dense_ids(r, "item_id"))
    factors = recommend.als(rank=3, iterations=2).fit(rows)
    tables = [selection.inspect(t.spark, m) for m in (tree, clusters, factors)]
    return tables[0].union(tables[1]).union(tables[2])


@query(
    "mdl_tree_table",
    f"SELECT model, n_rows, n_rows AS n_agree, CAST(n_trees AS BIGINT) AS n_trees, true AS whole FROM ({_TEST_ORDERS}), (VALUES ('tree', 1), ('forest', 8), ('boosted', 3)) v(model, n_trees)",
)
def _(t):
    """Nodes of saved models as tables; walked by column expressions they give the model's prediction on every test row."""
    _, _, train, test = _outcomes(t)
    models = {
        "tree": estimator("decision_tree_clf", maxDepth=5, maxBins=50, seed=1),
        "forest": estimator("random_forest_clf", numTrees=8, maxDepth=6, maxBins=150, seed=1),
        "boosted": estimator("gbt_clf", maxDepth=3, maxIter=3, seed=1),
    }
    parts = []
    for name, unfitted in models.items():
        fitted = unfitted.fit(train)
        saved = trees.read(t.spark, selection.save(fitted, scratch_path(t.spark, name)))
        walked = trees.predict(saved, fitted.transform(test), output="walked")
        agree = walked.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("prediction") == F.col("walked")).alias("n_agree"))
        n_trees = F.countDistinct("tree")
        shape = saved.nodes.agg(n_trees.alias("n_trees"), (F.count_if(F.col("left") < 0) - F.count_if(F.col("left") >= 0) == n_trees).alias("whole"))
        parts.append(agree.join(F.broadcast(shape)).withColumn("model", F.lit(name)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("ev_model_regression", "SELECT unnest(['mse', 'rmse', 'mae', 'r2']) AS metric, true AS agrees")
def _(t):
    """Our metrics of a fitted model against the library's evaluator."""
    scored = materialize(_regress(t, "gbt_reg", maxDepth=3, maxIter=5, seed=1), "scored")
    ours = regression_metrics(scored).first()
    found = {m: RegressionEvaluator(metricName=m).evaluate(scored) for m in ("mse", "rmse", "mae", "r2")}
    return t.spark.createDataFrame([(m, abs(ours[m] - v) <= 1e-6 * max(1.0, abs(v))) for m, v in found.items()], "metric string, agrees boolean")


@query("ev_model_curves", "SELECT model, CAST(16 AS BIGINT) AS n_points, true AS area_agrees, true AS starts_and_ends, true AS rises FROM (SELECT unnest(['linear', 'tree', 'boosted']) AS model)")
def _(t):
    """Curves of three fitted classifiers from one pass over the test rows, against the library's area."""
    _, _, train, test = _outcomes(t)
    models = {"linear": estimator("logistic_regression", maxIter=20), "tree": estimator("decision_tree_clf", maxDepth=4, maxBins=50, seed=1), "boosted": estimator("gbt_clf", maxDepth=3, maxIter=3, seed=1)}
    scored = test.select("o_orderkey", "label", "features")
    for name, unfitted in models.items():
        fitted = unfitted.fit(train)
        scored = fitted.transform(scored).withColumn(name, vector_to_array(fitted.getProbabilityCol())[1]).drop("rawPrediction", "probability", "prediction")
    scored = materialize(scored.select("label", *models), "scored")
    histograms = materialize(curves.score_histograms(scored, {m: F.col(m) for m in models}), "histograms")
    points = curves.curve_points(histograms)
    # Pairs that share a bin are all a histogram cannot order.
    share = F.sum(F.col("pos") * F.col("neg")) / (F.sum("pos") * F.sum("neg"))
    unsure = {r["model"]: r["share"] / 2 for r in histograms.groupBy("model").agg(share.alias("share")).collect()}
    found = {r["model"]: r["area_roc"] for r in curves.areas(points).collect()}
    exact = {m: BinaryClassificationEvaluator(rawPredictionCol=m).evaluate(scored) for m in models}
    agrees = F.create_map(*[F.lit(x) for m in models for x in (m, abs(found[m] - exact[m]) <= unsure[m] + 1e-4)])
    tpr, fpr = F.col("points")["tpr"], F.col("points")["fpr"]
    ends = F.get("points", F.lit(0)), F.element_at("points", -1)
    return curves.points_of_model(points, "point", "fpr", "tpr").select(
        "model", F.size("points").cast("bigint").alias("n_points"), agrees[F.col("model")].alias("area_agrees"),
        ((ends[0]["fpr"] + ends[0]["tpr"] == 0) & (ends[1]["fpr"] + ends[1]["tpr"] == 2)).alias("starts_and_ends"),
        ((tpr == F.sort_array(tpr)) & (fpr == F.sort_array(fpr))).alias("rises"),
    )
