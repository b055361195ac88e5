"""Join operators."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.storage import broadcast_if_small, materialize


def lookup(facts: DataFrame, names: DataFrame, fact_key: str, name_key: str, columns: Sequence[str]) -> DataFrame:
    """Attach columns of a dimension; a key without an entry gets nulls.

    The dimension is broadcast when it measures small and shuffled otherwise.
    """
    dim = names.select(F.col(name_key).alias("_key"), *columns)
    return facts.join(broadcast_if_small(dim), F.col(fact_key) == F.col("_key"), "left").drop("_key")


def lookup_few(few: DataFrame, names: DataFrame, fact_key: str, name_key: str, columns: Sequence[str]) -> DataFrame:
    """The same for the rows of a ``limit``: they are what is broadcast, and the dimension is only scanned."""
    dim = names.select(F.col(name_key).alias("_key"), *columns)
    return dim.join(F.broadcast(few), F.col(fact_key) == F.col("_key"), "right").select(*[few[c] for c in few.columns], *columns)


def left_outer_where(left: DataFrame, right: DataFrame, key: str, left_condition: Column) -> DataFrame:
    """Left outer join whose match needs an equal key and a test on the left row.

    All left rows stay; the test only decides whether the right side is looked up. It belongs to
    the join condition, so rows that fail it still shuffle by their own key: nulling their keys
    instead would send all of them to one task.
    """
    other = right.withColumnRenamed(key, "_right_key")
    return left.join(other, (F.col(key) == F.col("_right_key")) & left_condition, "left").drop("_right_key")


def exclude(df: DataFrame, flagged: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in ``flagged``: one anti join, however many keys are flagged.

    The keys are stored first, so that both sides reach the join through a plain exchange and
    Spark can split a key that holds much of ``df``.
    """
    return df.join(materialize(flagged.select(key).distinct(), "flagged"), key, "left_anti")


def totals_joined(facts: DataFrame, fact_key: str, aggs: Sequence[Column], dim: DataFrame, dim_key: str) -> DataFrame:
    """Inner join after aggregating the fact side to one row per key.

    The many-row side is reduced map-side before anything is shuffled, so a key holding a large
    share of the facts costs one row per task.
    """
    per_key = facts.groupBy(fact_key).agg(*aggs)
    return per_key.join(dim, F.col(fact_key) == F.col(dim_key), "inner")


def lookup_by_udf(facts: DataFrame, names: DataFrame, fact_key: str, name_key: str, name: str, output: str) -> DataFrame:
    """The lookup with its value read by an Arrow function: a join finds the entry, the function reads it.

    For callers whose value needs Python; a mapping of any size stays a table.
    """
    found = lookup(facts, names.withColumnRenamed(name, "_value"), fact_key, name_key, ["_value"])

    @F.pandas_udf("string")
    def read(values: pd.Series) -> pd.Series:
        return values.map(str, na_action="ignore")

    return found.withColumn(output, read(F.col("_value"))).drop("_value")
