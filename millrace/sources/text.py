"""Plain text readers and line parsers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.strings import leading_id, quoted_name


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def parse_records(lines: DataFrame, fields: Sequence[tuple[str, str]], sep: str = ",", column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split lines into typed records.

    Returns ``(records, rejects)``. A line is rejected, whole, when it has another number of
    fields or a non-empty field that does not cast; the job goes on.
    """
    values, whole = _typed(fields, sep, column)
    marked = lines.withColumn("_ok", whole)
    records = marked.filter("_ok").select([v.alias(n) for v, (n, _) in zip(values, fields)])
    rejects = marked.filter(~F.col("_ok")).drop("_ok")
    return records, rejects


def _typed(fields: Sequence[tuple[str, str]], sep: str, column: str) -> tuple[list[Column], Column]:
    """The fields of a line, and whether it is a record."""
    parts = F.split(F.col(column), f"\\Q{sep}\\E", -1)
    typed = [F.get(parts, F.lit(i)).try_cast(t) for i, (_, t) in enumerate(fields)]
    castable = F.lit(True)
    for i, value in enumerate(typed):
        castable = castable & (value.isNotNull() | (F.get(parts, F.lit(i)) == ""))
    return typed, F.coalesce((F.size(parts) == len(fields)) & castable, F.lit(False))


def store_parsed(lines: DataFrame, path: str, fields: Sequence[tuple[str, str]], sep: str = ",", column: str = "value") -> tuple[DataFrame, DataFrame]:
    """``parse_records`` in one scan: records and rejects are written apart by kind, and read back from there.

    ``lines`` holds its text in ``column``; of a reject that text is kept, of a record its fields.
    """
    typed, whole = _typed(fields, sep, column)
    names = [n for n, _ in fields]
    parsed = lines.select(
        F.when(whole, "record").otherwise("reject").alias("_kind"), F.when(~whole, F.col(column)).alias("_line"), *[F.when(whole, v).alias(n) for v, n in zip(typed, names)]
    )
    parsed.write.mode("overwrite").partitionBy("_kind").parquet(path)
    schema = ", ".join(["_line string", *[f"`{n}` {t}" for n, t in fields], "_kind string"])
    stored = lines.sparkSession.read.schema(schema).parquet(path)
    return stored.filter("_kind = 'record'").select(*[f"`{n}`" for n in names]), stored.filter("_kind = 'reject'").select(F.col("_line").alias(column))


def parse_quoted(lines: DataFrame, below: int | None = None, column: str = "value") -> DataFrame:
    """``id "NAME"`` lines as (id, name); lines without a quoted name, or with id >= ``below``, go."""
    out = lines.select(leading_id(F.col(column)).alias("id"), quoted_name(F.col(column)).alias("name"))
    out = out.filter(F.col("id").isNotNull() & F.col("name").isNotNull())
    return out if below is None else out.filter(F.col("id") < below)
