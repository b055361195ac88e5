"""Row predicates over many columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def any_null(columns: Sequence[str]) -> Column:
    """True when at least one of the columns is null."""
    return reduce(or_, [F.col(f"`{c}`").isNull() for c in columns])


def rows_with_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.filter(any_null(columns or df.columns))


def equals_marker(df: DataFrame, column: str, marker: str = "?") -> DataFrame:
    """Rows whose text column equals a missing-value marker; none when the column is not text."""
    is_text = dict(df.dtypes)[column] == "string"
    return df.filter(F.col(column) == marker if is_text else F.lit(False))
