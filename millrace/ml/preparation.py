"""Cleaning and coding of a training table, fitted once and applied alike to any later table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from millrace.ml.features import bin_columns, category_pipeline
from millrace.operators.aggregates import modes, quantiles
from millrace.operators.cleaning import clip, replace_marker


@dataclass(frozen=True)
class Preparation:
    """Clip limits, marker replacements, interval edges and category codes of a training table."""

    limits: Mapping[str, tuple[float, float]]
    replacements: Mapping[str, str]
    edges: Mapping[str, Sequence[float]]
    marker: str
    model: PipelineModel

    @classmethod
    def fit(
        cls,
        train: DataFrame,
        edges: Mapping[str, Sequence[float]],
        categories: Sequence[str],
        label: str,
        marker: str = "?",
        low: float = 0.05,
        high: float = 0.95,
        error: float = 0.0,
    ) -> Preparation:
        """Learn from ``train``: clip the numeric columns in ``edges`` to their low and high quantile,
        replace the marker in ``categories`` by the mode, bin, and code categories and bins."""
        found = quantiles(train, list(edges), [low, high], error)
        limits = {c: (lo, hi) for c, (lo, hi) in found.items() if lo is not None}
        replacements = {r["column"]: r["mode"] for r in modes(train, categories, ignore=marker).collect()}
        ready = _clean(train, limits, replacements, edges, marker)
        pipeline = category_pipeline([*categories, *[f"{c}_bin" for c in edges]], label)
        return cls(limits, replacements, edges, marker, pipeline.fit(ready))

    def transform(self, df: DataFrame) -> DataFrame:
        """``features`` and ``label`` columns, with the fitted limits, modes and codes."""
        return self.model.transform(_clean(df, self.limits, self.replacements, self.edges, self.marker))


def _clean(df, limits, replacements, edges, marker):
    return bin_columns(replace_marker(clip(df, limits), replacements, marker), edges)
