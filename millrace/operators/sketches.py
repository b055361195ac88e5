"""Quantile sketches per group that are stored, merged and read without a second scan of the rows.

A sketch has a bounded size whatever it has seen. With ``k`` = 800 the rank of a quantile is off by less
than 0.5 % of the rows of its group in 99 of 100 cases; nulls and NaN count for nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 800


def quantile_sketches(df: DataFrame, keys: Sequence[str], value: str, k: int = K) -> DataFrame:
    """One row per combination of ``keys`` with ``sketch``; sketches combine map-side."""
    number = F.col(value).cast("double")
    return df.filter(number.isNotNull() & ~F.isnan(number)).groupBy(*keys).agg(F.kll_sketch_agg_double(number, F.lit(k)).alias("sketch"))


def merge_sketches(sketches: DataFrame, keys: Sequence[str], k: int = K) -> DataFrame:
    """Sketches of the coarser groups ``keys``."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def sketched_quantiles(sketches: DataFrame, keys: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """``keys``, ``share``, ``n`` (values seen) and ``value``: one row per group and share."""
    read = [F.struct(F.lit(float(s)).alias("share"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(s))).alias("value")) for s in shares]
    each = sketches.select(*keys, F.kll_sketch_get_n_double("sketch").alias("n"), F.explode(F.array(*read)).alias("_read"))
    return each.select(*keys, "_read.share", "n", "_read.value")
