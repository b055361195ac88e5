"""Cleaning as pipeline stages: fitted on training rows, saved and loaded inside a ``PipelineModel``.

What a stage has learned (limits, modes) or was given (edges, labels) are its params, so the
pipeline's own writer keeps them and a later session transforms alike. All stages are column
expressions: a transformed table needs no extra job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import interval_label
from millrace.ml.features import CENSUS_DEFAULTS, CENSUS_EDGES, CENSUS_LABELS
from millrace.operators.aggregates import modes, quantiles
from millrace.operators.cleaning import clip, replace_marker


class _Saved(DefaultParamsReadable, DefaultParamsWritable):
    """A stage that is its params; it can be made without any, as its reader does."""

    def _given(self, **values: object) -> None:
        self._set(**{k: v for k, v in values.items() if v is not None})


class Clip(Estimator, HasInputCols, _Saved):
    """Learns each column's ``low`` and ``high`` quantile; exact unless an ``error`` is allowed."""

    low = Param(Params._dummy(), "low", "lower quantile", TypeConverters.toFloat)
    high = Param(Params._dummy(), "high", "upper quantile", TypeConverters.toFloat)
    error = Param(Params._dummy(), "error", "allowed rank error", TypeConverters.toFloat)

    def __init__(self, inputCols: Sequence[str] | None = None, low: float | None = None, high: float | None = None, error: float | None = None):
        super().__init__()
        self._setDefault(low=0.05, high=0.95, error=0.0)
        self._given(inputCols=inputCols, low=low, high=high, error=error)

    def _fit(self, dataset: DataFrame) -> ClipModel:
        probs = [self.getOrDefault(self.low), self.getOrDefault(self.high)]
        found = quantiles(dataset, self.getInputCols(), probs, self.getOrDefault(self.error))
        # A column without values has no limits.
        some = [c for c in self.getInputCols() if len(found[c]) == 2 and None not in found[c]]
        return ClipModel(some, [found[c][0] for c in some], [found[c][1] for c in some])


class ClipModel(Model, HasInputCols, _Saved):
    """Holds columns between their limits; they become double, nulls stay."""

    lows = Param(Params._dummy(), "lows", "lower limits", TypeConverters.toListFloat)
    highs = Param(Params._dummy(), "highs", "upper limits", TypeConverters.toListFloat)

    def __init__(self, inputCols: Sequence[str] | None = None, lows: Sequence[float] | None = None, highs: Sequence[float] | None = None):
        super().__init__()
        self._given(inputCols=inputCols, lows=lows, highs=highs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return clip(dataset, dict(zip(self.getInputCols(), zip(self.getOrDefault(self.lows), self.getOrDefault(self.highs)))))


class FillMode(Estimator, HasInputCols, _Saved):
    """Learns each column's most frequent value other than ``marker``; among equals the smallest."""

    marker = Param(Params._dummy(), "marker", "stands for a missing value", TypeConverters.toString)

    def __init__(self, inputCols: Sequence[str] | None = None, marker: str | None = None):
        super().__init__()
        self._setDefault(marker="?")
        self._given(inputCols=inputCols, marker=marker)

    def _fit(self, dataset: DataFrame) -> FillModeModel:
        marker = self.getOrDefault(self.marker)
        found = {r["column"]: r["mode"] for r in modes(dataset, self.getInputCols(), ignore=marker).collect()}  # a row per column
        some = [c for c in self.getInputCols() if c in found]
        return FillModeModel(some, [found[c] for c in some], marker)


class FillModeModel(Model, HasInputCols, _Saved):
    """Puts the mode where the marker stands; nulls stay."""

    modes = Param(Params._dummy(), "modes", "value for each column", TypeConverters.toListString)
    marker = Param(Params._dummy(), "marker", "stands for a missing value", TypeConverters.toString)

    def __init__(self, inputCols: Sequence[str] | None = None, modes: Sequence[str] | None = None, marker: str | None = None):
        super().__init__()
        self._given(inputCols=inputCols, modes=modes, marker=marker)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return replace_marker(dataset, dict(zip(self.getInputCols(), self.getOrDefault(self.modes))), self.getOrDefault(self.marker))


class Intervals(Transformer, HasInputCol, HasOutputCol, _Saved):
    """Label of the interval that holds a number; both edges are inclusive, the first interval wins."""

    edges = Param(Params._dummy(), "edges", "interval edges in order", TypeConverters.toListFloat)
    labels = Param(Params._dummy(), "labels", "a label per interval", TypeConverters.toListString)
    default = Param(Params._dummy(), "default", "label outside all intervals, and of nulls", TypeConverters.toString)

    def __init__(
        self, inputCol: str | None = None, outputCol: str | None = None, edges: Sequence[float] | None = None,
        labels: Sequence[str] | None = None, default: str | None = None,
    ):
        super().__init__()
        self._setDefault(default="Out")
        if edges is not None and labels is None:
            labels = [f"{lo}-{hi}" for lo, hi in zip(edges, edges[1:])]
        self._given(inputCol=inputCol, outputCol=outputCol, edges=edges, labels=labels, default=default)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        label = interval_label(F.col(f"`{self.getInputCol()}`"), self.getOrDefault(self.edges), self.getOrDefault(self.labels), self.getOrDefault(self.default))
        return dataset.withColumn(self.getOutputCol(), label)


def census_cleaning(categories: Sequence[str], clipped: Sequence[str] = (), marker: str = "?", suffix: str = "_bin") -> list:
    """Stages for census tables: modes for markers, limits, and an interval label for each of the nine numbers."""
    fill = [FillMode(list(categories), marker)] if categories else []
    limits = [Clip(list(clipped))] if clipped else []
    bins = [Intervals(c, c + suffix, edges, CENSUS_LABELS.get(c), CENSUS_DEFAULTS.get(c)) for c, edges in CENSUS_EDGES.items()]
    return [*fill, *limits, *bins]
