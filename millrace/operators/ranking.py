"""Positions, ranks and running totals over a whole table, without a single-task window.

A window with no partition key, or with one key that holds most rows, runs in one task. Here the
table is range-partitioned on the full sort order (a unique last sort column keeps even a heavily
repeated value spread over many tasks), written once, and each partition is given the total of
those before it. Only one row per sort partition is ever gathered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.storage import materialize

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below these bits
_UP_TO_HERE = (Window.unboundedPreceding, Window.currentRow)


def _sorted_stage(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stage = materialize(placed.withColumn("_mid", F.monotonically_increasing_id()), "sorted")
    return stage.withColumn("_part", F.shiftright("_mid", _ROW_BITS))


def _before(parts: DataFrame, names: Sequence[str]) -> DataFrame:
    """Per sort partition, the totals of all earlier partitions (a few thousand rows at most)."""
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("_part", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_before_{n}") for n in names])


def with_position(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """Dense 0-based position of every row under ``order``; ``order`` should end in a unique column."""
    stage = _sorted_stage(df, order)
    offsets = _before(stage.groupBy("_part").agg(F.count(F.lit(1)).alias("n")), ["n"])
    local = F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    placed = stage.join(F.broadcast(offsets), "_part")
    return placed.withColumn(name, F.col("_before_n") + local).drop("_part", "_mid", "_before_n")


def rank_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "rank") -> DataFrame:
    """``row_number() over (partition by keys order by order)``, for groups of any size."""
    placed = with_position(df, [*[F.col(k) for k in keys], *order], "_pos")
    starts = placed.groupBy(*keys).agg(F.min("_pos").alias("_start"))
    starts = starts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_start")
    same_key = [placed[k].eqNullSafe(starts[f"_k_{k}"]) for k in keys]
    joined = placed.join(starts, same_key)
    return joined.withColumn(name, F.col("_pos") - F.col("_start") + 1).drop("_pos", "_start", *[f"_k_{k}" for k in keys])


def with_running_sums(df: DataFrame, order: Sequence[Column], sums: Mapping[str, Column]) -> DataFrame:
    """Running totals, current row included, of several expressions under one global order."""
    stage = _sorted_stage(df.withColumns({f"_v_{n}": c for n, c in sums.items()}), order)
    parts = stage.groupBy("_part").agg(*[F.sum(f"_v_{n}").alias(n) for n in sums])
    offsets = _before(parts, list(sums))
    here = Window.partitionBy("_part").orderBy("_mid").rowsBetween(*_UP_TO_HERE)
    out = stage.join(F.broadcast(offsets), "_part").withColumns(
        {n: F.col(f"_before_{n}") + F.coalesce(F.sum(f"_v_{n}").over(here), F.lit(0)) for n in sums}
    )
    return out.drop("_part", "_mid", *[f"_v_{n}" for n in sums], *[f"_before_{n}" for n in sums])


def ntile(df: DataFrame, buckets: int, order: Sequence[Column], name: str = "tile") -> DataFrame:
    """``ntile(buckets)`` over the whole table: contiguous blocks whose sizes differ by at most one."""
    placed = with_position(df, order, "_pos")
    total = placed.agg(F.count(F.lit(1))).first()[0]
    size, extra = divmod(total, buckets)
    longer = extra * (size + 1)
    pos = F.col("_pos")
    tile = F.when(pos < longer, F.floor(pos / (size + 1)))
    if size:
        tile = tile.otherwise(extra + F.floor((pos - longer) / size))
    return placed.withColumn(name, (tile + 1).cast("int")).drop("_pos")


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows per key. Spark cuts to ``k`` rows per key before the shuffle as well."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key under ``order``; ``order`` must break ties."""
    return top_per_key(df, keys, order, 1, "_rank").drop("_rank")
