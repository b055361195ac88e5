"""Table metadata with fill counts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def schema_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column of every table: name, type, non-null values and rows; one scan per table."""
    return reduce(DataFrame.unionByName, [_profile(name, df) for name, df in tables.items()])


def _profile(name: str, df: DataFrame) -> DataFrame:
    columns = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.count(F.col(f"`{f.name}`")).alias("n_present"),
            F.count(F.lit(1)).alias("n_rows"),
        )
        for f in df.schema.fields
    ]
    rows = df.agg(F.array(*columns).alias("c")).select(F.explode("c").alias("c"))
    return rows.select(F.lit(name).alias("table_name"), "c.*")
