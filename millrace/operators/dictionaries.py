"""Dictionaries of natural keys that grow from load to load.

Each load is a version of its own below the dictionary's folder: keys that no earlier version holds,
numbered on from where the earlier ones end, in the order of the key. A number once given never changes.
A load that runs again replaces its version and gives the same numbers. A null key has no number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from millrace.operators.ranking import with_position


def _folder(path: str, version: int) -> str:
    return f"{path}/version={version}"


def grow(keys: DataFrame, key: str, path: str, version: int) -> DataFrame:
    """Write the new keys of ``keys`` as ``version`` (from 1, without gaps); the dictionary up to it comes back."""
    if version < 1:
        raise ValueError("versions start at 1")
    spark, kind = keys.sparkSession, keys.schema[key].dataType
    fresh = keys.select(F.col(key).alias("key")).filter("key IS NOT NULL").distinct()
    start = 0
    if version > 1:
        known = read(spark, path, version - 1, kind)
        fresh = fresh.join(known.select("key"), "key", "left_anti")
        highest = known.agg(F.max("code")).first()[0]
        start = 0 if highest is None else highest + 1
    numbered = with_position(fresh, [F.col("key")], "code").select("key", (F.col("code") + start).alias("code"))
    numbered.write.mode("overwrite").parquet(_folder(path, version))
    return read(spark, path, version, kind)


def read(spark: SparkSession, path: str, version: int, kind) -> DataFrame:
    """``key``, ``code``, ``version`` of all loads up to ``version``; ``kind`` is the type of the keys."""
    schema = StructType([StructField("key", kind), StructField("code", LongType())])
    files = spark.read.schema(schema).option("basePath", path).parquet(*[_folder(path, v) for v in range(1, version + 1)])
    return files.select("key", "code", F.col("version").cast("int").alias("version"))


def encode(df: DataFrame, key: str, dictionary: DataFrame, code: str = "code") -> DataFrame:
    """``df`` with the number of its key, null for a key that the dictionary lacks. Both sides are stored tables, so hot keys are split."""
    numbers = dictionary.select(F.col("key").alias("_key"), F.col("code").alias("_code"))
    return df.join(numbers, F.col(key) == F.col("_key"), "left").withColumn(code, F.col("_code")).drop("_key", "_code")


def unseen(df: DataFrame, key: str, dictionary: DataFrame) -> DataFrame:
    """Keys of ``df`` that the dictionary lacks, with their number of rows."""
    counted = df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return counted.join(dictionary.select("key"), "key", "left_anti")
