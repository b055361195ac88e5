"""Parameter search, model comparison, refit, persistence and inspection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import unit_hash
from millrace.storage import materialize, spread


def grid(est: Estimator, values: Mapping[str, Sequence[object]]) -> list[dict]:
    builder = ParamGridBuilder()
    for name, options in values.items():
        builder = builder.addGrid(est.getParam(name), list(options))
    return builder.build()


def _table(spark: SparkSession, maps: Sequence[dict], scores: Sequence[float]) -> DataFrame:
    rows = [
        (i, ", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda e: e[0].name)), float(s))
        for i, (m, s) in enumerate(zip(maps, scores))
    ]
    return spark.createDataFrame(rows, "candidate int, params string, score double")


def cross_validate(
    est: Estimator, maps: Sequence[dict], evaluator: Evaluator, df: DataFrame, key: str, folds: int = 2, parallelism: int = 2
) -> tuple[Model, dict, DataFrame]:
    """k-fold grid search; the fold of a row comes from a hash of its key, so reruns agree.

    Rows are stored once with their fold, and every fold reads them there, spread by their key. Returns (best model, best parameters, one row per candidate).
    """
    folded = df.withColumn("_fold", F.floor(unit_hash(F.col(key), salt="fold") * folds).cast("int"))
    folded = spread(materialize(folded, "folds"), key)
    cv = CrossValidator(
        estimator=est, estimatorParamMaps=maps, evaluator=evaluator, numFolds=folds, foldCol="_fold", parallelism=parallelism
    )
    model = cv.fit(folded)
    best = _best(model.avgMetrics, evaluator)
    return model.bestModel, maps[best], _table(df.sparkSession, maps, model.avgMetrics)


def train_validation(
    est: Estimator, maps: Sequence[dict], evaluator: Evaluator, df: DataFrame, ratio: float = 0.8, seed: int = 1, parallelism: int = 2
) -> tuple[Model, dict, DataFrame]:
    """Grid search on a single split."""
    tvs = TrainValidationSplit(
        estimator=est, estimatorParamMaps=maps, evaluator=evaluator, trainRatio=ratio, seed=seed, parallelism=parallelism
    )
    model = tvs.fit(df)
    best = _best(model.validationMetrics, evaluator)
    return model.bestModel, maps[best], _table(df.sparkSession, maps, model.validationMetrics)


def _best(scores: Sequence[float], evaluator: Evaluator) -> int:
    pick = max if evaluator.isLargerBetter() else min
    return scores.index(pick(scores))


def compare(
    estimators: Mapping[str, Estimator], evaluator: Evaluator, train: DataFrame, test: DataFrame
) -> tuple[str, dict[str, Model], DataFrame]:
    """Fit several estimators on one cached training set; returns (winner, models, score table)."""
    train = train.persist()
    try:
        models = {name: est.fit(train) for name, est in estimators.items()}
    finally:
        train.unpersist()
    scores = {name: float(evaluator.evaluate(m.transform(test))) for name, m in models.items()}
    pick = max if evaluator.isLargerBetter() else min
    rows = [(n, evaluator.getMetricName(), s) for n, s in scores.items()]
    return pick(scores, key=scores.get), models, train.sparkSession.createDataFrame(rows, "model string, metric string, value double")


def refit(est: Estimator, params: dict, df: DataFrame) -> Model:
    """Fit the winner's parameters on all training rows."""
    return est.copy(params).fit(df)


def save(model: Transformer, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def as_pipeline(*stages: Transformer) -> PipelineModel:
    """Fitted stages as one savable model, so that scoring repeats the fitted feature codes."""
    return PipelineModel(stages=list(stages))


def inspect(spark: SparkSession, model: Model) -> DataFrame:
    """Parameters of a fitted model, and its tree text, centres or coefficients, as (name, value) rows."""
    rows = [("class", type(model).__name__)]
    rows += sorted((p.name, str(v)) for p, v in model.extractParamMap().items())
    if hasattr(model, "toDebugString"):
        rows += [("tree", line.strip()) for line in model.toDebugString.splitlines()]
    if hasattr(model, "clusterCenters"):
        rows += [("centre", str([round(float(x), 6) for x in c])) for c in model.clusterCenters()]
    if hasattr(model, "itemFactors"):
        rows += [("item_factors", str(model.itemFactors.count())), ("user_factors", str(model.userFactors.count()))]
    return spark.createDataFrame(rows, "name string, value string")
