"""Feature columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import interval_label

# Interval edges of the numeric census columns. Labels are "low-high" unless listed.
CENSUS_EDGES: dict[str, list[float]] = {
    "age": [0, 18, 35, 50, 70, 100],
    "wage_per_hour": [0, 740, 1480, 2220, 3000, 10000],
    "capital_gains": [0, 500, 1000, 1500, 2000, 100000],
    "capital_losses": [0, 1120, 1680, 2240, 2800, 5000],
    "dividends_from_stocks": [0, 500, 1000, 5000, 10000, 100000],
    "total_person_earnings": [0, 740, 1480, 2220, 3000, 100000],
    "num_persons_worked_for_employer": [0, 2, 4, 6, 8, 10],
    "weeks_worked_in_year": [0, 10, 20, 30, 40, 55],
    "own_business_or_self_employed": [0, 1, 2, 6],
}
CENSUS_LABELS: dict[str, list[str]] = {"age": ["0-18", "19-35", "36-50", "51-70", "71-100"]}
CENSUS_DEFAULTS: dict[str, str] = {"own_business_or_self_employed": "own_business_or_self_employed"}


def bin_columns(
    df: DataFrame,
    edges: Mapping[str, Sequence[float]],
    labels: Mapping[str, Sequence[str]] | None = None,
    defaults: Mapping[str, str] | None = None,
    suffix: str = "_bin",
) -> DataFrame:
    """An interval-label column next to every listed numeric column, in one projection."""
    labels, defaults = labels or {}, defaults or {}
    return df.withColumns(
        {
            c + suffix: interval_label(F.col(c), e, labels.get(c), defaults.get(c, "Out"))
            for c, e in edges.items()
        }
    )


def indexer(columns: Sequence[str], order: str = "frequencyDesc", invalid: str = "keep", suffix: str = "_idx") -> StringIndexer:
    """Category codes; a category unseen in training gets a code of its own."""
    return StringIndexer(
        inputCols=list(columns), outputCols=[c + suffix for c in columns], stringOrderType=order, handleInvalid=invalid
    )


def one_hot(columns: Sequence[str], suffix: str = "_vec", drop_last: bool = True) -> OneHotEncoder:
    return OneHotEncoder(inputCols=list(columns), outputCols=[c + suffix for c in columns], dropLast=drop_last)


def assembler(columns: Sequence[str], output: str = "features", invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=invalid)


def min_max(input_col: str = "features", output: str = "scaled") -> MinMaxScaler:
    return MinMaxScaler(inputCol=input_col, outputCol=output)


def standard(input_col: str = "features", output: str = "scaled", centre: bool = False) -> StandardScaler:
    return StandardScaler(inputCol=input_col, outputCol=output, withMean=centre, withStd=True)


def category_pipeline(categories: Sequence[str], label: str, numbers: Sequence[str] = ()) -> Pipeline:
    """Index categories and label, then assemble. Fit it on training rows and reuse it for scoring."""
    return Pipeline(
        stages=[
            indexer(categories),
            StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetDesc", handleInvalid="error"),
            assembler([c + "_idx" for c in categories] + list(numbers)),
        ]
    )


def fit_transform(pipeline: Pipeline, train: DataFrame, *others: DataFrame) -> tuple[PipelineModel, list[DataFrame]]:
    """Fit once on ``train`` and apply the same fitted codes to every frame."""
    model = pipeline.fit(train)
    return model, [model.transform(df) for df in (train, *others)]
