"""Set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def except_rows(df: DataFrame, taken: DataFrame) -> DataFrame:
    """Distinct rows of ``df`` that are not in ``taken`` (columns by position).

    Rows of both sides are marked and grouped in one aggregation, which combines copies map-side, so that
    many copies of one row do not meet in one task and neither side is sorted for a join.
    """
    names = [f"_c{i}" for i in range(len(df.columns))]
    marked = df.toDF(*names).select("*", F.lit(0).alias("_taken")).union(taken.select("*", F.lit(1)))
    left = marked.groupBy(*names).agg(F.max("_taken").alias("_taken")).filter("_taken = 0")
    return left.select(*names).toDF(*df.columns)
