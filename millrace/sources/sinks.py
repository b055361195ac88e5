"""Writers. Each returns the path it wrote, so that a later step can read it back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, header: bool = False, sep: str = ",", **options: object) -> str:
    """A CSV folder, one file per task, replacing what was there."""
    df.write.mode("overwrite").options(header=header, sep=sep, **options).csv(path)
    return path


def write_parquet(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def write_lines(df: DataFrame, path: str, columns: Sequence[str], sep: str = ";", single: bool = False) -> str:
    """Rows as formatted text lines.

    ``single=True`` asks for one file and is for reports whose row count does not grow with the
    input; what makes the rows still runs in many tasks. Without it every task writes its own file.
    """
    line = df.select(F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]).alias("value"))
    (line.repartition(1) if single else line).write.mode("overwrite").text(path)
    return path


def write_dictionary(df: DataFrame, path: str, key: str, code: str) -> str:
    """Distinct (natural key, integer code) pairs as a lookup file."""
    return write_csv(df.select(key, code).distinct(), path, escape='"')
