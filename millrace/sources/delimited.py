"""Delimited text readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_typed(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",", **options: object) -> DataFrame:
    """Headerless delimited text with a declared schema: one pass, no inference.

    ``sep`` may be several characters (``"::"``). Files split across tasks as long as no field
    holds a line break; pass ``multiLine=True`` for those.
    """
    return spark.read.schema(schema).options(sep=sep, **options).csv(path)


def read_inferred(spark: SparkSession, path: str, sep: str = ",", sampling: float = 1.0) -> DataFrame:
    """Header line gives the names, the values give the types (an extra pass over ``sampling``)."""
    return spark.read.options(header=True, inferSchema=True, sep=sep, samplingRatio=sampling).csv(path)


def read_strings(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Header line gives the names, every column is text."""
    return spark.read.options(header=True, sep=sep).csv(path)


def cast_all(df: DataFrame, dtype: str = "double") -> DataFrame:
    """Every column cast; values that are not of the type become null."""
    return df.select([F.col(f"`{c}`").try_cast(dtype).alias(c) for c in df.columns])


def read_positional(spark: SparkSession, path: str, names: Sequence[str], types: Sequence[str], sep: str = ",") -> DataFrame:
    """Headerless part files whose columns are named, and typed, by position."""
    raw = spark.read.schema(", ".join(f"_c{i} string" for i in range(len(names)))).option("sep", sep).csv(path)
    named = raw.toDF(*names)
    return named.select([F.col(n).try_cast(t).alias(n) for n, t in zip(names, types)])


def read_trimmed(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",") -> DataFrame:
    """As :func:`read_typed`, with the blanks after each separator removed."""
    return read_typed(spark, path, schema, sep, ignoreLeadingWhiteSpace=True)


def read_charset(spark: SparkSession, path: str, schema: StructType | str, sep: str = "|", encoding: str = "ISO-8859-1") -> DataFrame:
    """Delimited text in another character set."""
    return read_typed(spark, path, schema, sep, encoding=encoding)
