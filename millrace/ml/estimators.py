"""Named estimators with the parameters the library tunes."""

from __future__ import annotations

from pyspark.ml.base import Estimator
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)

ESTIMATORS: dict[str, type[Estimator]] = {
    "linear_regression": LinearRegression,
    "decision_tree_reg": DecisionTreeRegressor,
    "random_forest_reg": RandomForestRegressor,
    "gbt_reg": GBTRegressor,
    "logistic_regression": LogisticRegression,
    "linear_svc": LinearSVC,
    "decision_tree_clf": DecisionTreeClassifier,
    "random_forest_clf": RandomForestClassifier,
    "gbt_clf": GBTClassifier,
    "naive_bayes": NaiveBayes,
    "kmeans": KMeans,
}


def estimator(name: str, **params: object) -> Estimator:
    """An unfitted estimator by name, e.g. ``estimator("gbt_reg", maxDepth=3, seed=1)``."""
    return ESTIMATORS[name](**params)
