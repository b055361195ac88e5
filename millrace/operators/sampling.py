"""Splits, samples and folds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import unit_hash
from millrace.operators.ranking import ntile, top_per_key


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Seeded random split; the parts depend on how the input is partitioned."""
    return df.randomSplit(list(weights), seed)


def hash_split(df: DataFrame, keys: Sequence[str], weights: Sequence[float], salt: str = "", name: str = "split") -> DataFrame:
    """Split number per row from a hash of its key: the same on every run and cluster, no shuffle."""
    u = unit_hash(*[F.col(k) for k in keys], salt=salt)
    total, edge, label = sum(weights), 0.0, F.lit(None).cast("int")
    for i, w in reversed(list(enumerate(weights))):
        edge = sum(weights[: i + 1]) / total
        label = F.when(u < edge, F.lit(i)).otherwise(label) if i < len(weights) - 1 else F.lit(i)
    return df.withColumn(name, label)


def stratified(df: DataFrame, column: str, fractions: Mapping[object, float], seed: int) -> DataFrame:
    """Bernoulli sample with one fraction per value; values without a fraction are left out."""
    return df.sampleBy(column, dict(fractions), seed)


def stratified_by_hash(df: DataFrame, column: str, fractions: Mapping[object, float], keys: Sequence[str], salt: str = "") -> DataFrame:
    """Stratified sample decided by a hash of the key, so that a rerun keeps the same rows."""
    u = unit_hash(*[F.col(k) for k in keys], salt=salt)
    limit = F.lit(0.0)
    for value, fraction in fractions.items():
        limit = F.when(F.col(column) == value, F.lit(float(fraction))).otherwise(limit)
    return df.filter(u < limit)


def holdout_per_key(
    df: DataFrame, key: str, unique: Sequence[str], order: Sequence[Column], start: int, stop: int
) -> tuple[DataFrame, DataFrame]:
    """``(base, test)``: each key's start-th to stop-th row, in ``order``, goes to test.

    Only the first ``stop`` rows per key are ever ranked, so a key with very many rows is cut
    before the shuffle; ``unique`` columns identify a row for taking the test rows out of base.
    """
    test = top_per_key(df, [key], order, stop, "_rank").filter(F.col("_rank") >= start).drop("_rank")
    base = df.join(test.select(*unique), list(unique), "left_anti")
    return base, test


def contiguous_folds(df: DataFrame, folds: int, order: Sequence[Column]) -> DataFrame:
    """Column ``fold`` 1..folds over contiguous blocks of the ordered table."""
    return ntile(df, folds, order, "fold")
