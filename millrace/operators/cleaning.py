"""Missing values, markers, outliers and untrustworthy users."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.aggregates import modes, quantiles
from millrace.storage import materialize


def fill_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls become the column mean (cut to a whole number in an integer column)."""
    means = df.agg(*[F.avg(c).alias(c) for c in columns]).first().asDict()
    return df.na.fill({c: m for c, m in means.items() if m is not None})


def replace_marker(df: DataFrame, replacements: Mapping[str, str], marker: str = "?") -> DataFrame:
    """The marker becomes the given value of its column."""
    return df.withColumns(
        {c: F.when(F.col(c) == marker, F.lit(v)).otherwise(F.col(c)) for c, v in replacements.items()}
    )


def marker_to_mode(df: DataFrame, columns: Sequence[str], marker: str = "?") -> DataFrame:
    """A missing-value marker becomes the column's most frequent real value; one job for all columns."""
    found = {r["column"]: r["mode"] for r in modes(df, columns, ignore=marker).collect()}
    return replace_marker(df, found, marker)


def drop_iqr_outliers(df: DataFrame, columns: Sequence[str], factor: float = 1.5, error: float = 0.0) -> DataFrame:
    """Drop rows outside ``[q1 - f*iqr, q3 + f*iqr]`` in any listed column, and rows null there."""
    keep = F.lit(True)
    for c, (q1, q3) in quantiles(df, columns, [0.25, 0.75], error).items():
        if q1 is None:  # no values at all: nothing lies inside
            return df.filter(F.lit(False))
        reach = factor * (q3 - q1)
        keep = keep & F.col(c).between(q1 - reach, q3 + reach)
    return df.filter(keep)


def clip(df: DataFrame, limits: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Columns held between their limits; they become double, nulls stay."""
    clipped = {}
    for c, (lo, hi) in limits.items():
        v = F.col(c).cast("double")
        clipped[c] = F.when(v < lo, lo).when(v > hi, hi).otherwise(v)
    return df.withColumns(clipped)


def winsorize(df: DataFrame, columns: Sequence[str], low: float = 0.05, high: float = 0.95, error: float = 0.0) -> DataFrame:
    """Clip columns to their low and high quantile."""
    found = quantiles(df, columns, [low, high], error)
    return clip(df, {c: (lo, hi) for c, (lo, hi) in found.items() if lo is not None})


def user_profile(ratings: DataFrame) -> DataFrame:
    """Per user: row count, deviation of the rating times, share of the most common rating."""
    per_user = ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("ts").alias("ts_stddev"))
    per_value = ratings.groupBy("user_id", "rating").agg(F.count(F.lit(1)).alias("m"))
    common = per_value.groupBy("user_id").agg(F.max("m").alias("most"))
    return per_user.join(common, "user_id").select(
        "user_id", "n", "ts_stddev", F.round(F.col("most") * 100.0 / F.col("n"), 2).alias("top_share")
    )


def suspicious_users(
    ratings: DataFrame, min_rows: int = 50, max_stddev: float = 31_622_400.0, max_share: float = 90.0
) -> DataFrame:
    """Users with more than ``min_rows`` rows who rate in a burst, or nearly always alike."""
    burst = F.col("ts_stddev") < max_stddev
    alike = F.col("top_share") > max_share
    return user_profile(ratings).filter((F.col("n") > min_rows) & (burst | alike))


def drop_suspicious(ratings: DataFrame, **rules: float) -> DataFrame:
    flagged = materialize(suspicious_users(ratings, **rules).select("user_id"), "flagged")  # a plain exchange lets a hot user be split
    return ratings.join(flagged, "user_id", "left_anti")
