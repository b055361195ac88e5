"""Literal rows and table metadata as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small literal table with named, typed columns."""
    return spark.createDataFrame(list(rows), schema)
