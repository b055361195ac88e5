"""Grouped and global aggregates. All of them combine map-side before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ranking import with_position, with_running_sums


def histogram(df: DataFrame, keys: str | Sequence[str], name: str = "n") -> DataFrame:
    """Rows per value (or combination of values)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def mean_by_key(df: DataFrame, key: str, value: str, name: str = "mean", digits: int | None = None) -> DataFrame:
    mean = F.avg(value)
    return df.groupBy(key).agg((mean if digits is None else F.round(mean, digits)).alias(name))


def truncated_mean_by_key(df: DataFrame, key: str, value: str, name: str = "mean") -> DataFrame:
    """Mean of an integer column by integer division: sum and count in one pass."""
    pair = df.groupBy(key).agg(F.sum(value).alias("_s"), F.count(value).alias("_n"))
    return pair.select(key, F.expr("_s div _n").alias(name))


def spread_by_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """Sample standard deviation and row count per key; a single row has deviation 0."""
    return df.groupBy(key).agg(
        F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("stddev"), F.count(F.lit(1)).alias("n")
    )


def value_shares_by_key(df: DataFrame, key: str, value: str, values: Sequence[object], prefix: str = "share_") -> DataFrame:
    """Percentage of each listed value per key, one column per value, plus the row count."""
    shares = [
        F.round(F.avg(F.when(F.col(value) == v, 100.0).otherwise(0.0)), 2).alias(f"{prefix}{v}") for v in values
    ]
    return df.groupBy(key).agg(*shares, F.count(F.lit(1)).alias("n"))


def share_of_total(df: DataFrame, keys: Sequence[str], digits: int = 4) -> DataFrame:
    """Rows per group and their percentage of all rows; the total comes in as a scalar subquery."""
    counts = histogram(df, keys)
    total = df.agg(F.count(F.lit(1)).alias("t"))
    return counts.withColumn("pct", F.round(F.col("n") * 100.0 / total.scalar(), digits))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of distinct values of every listed column, long form.

    Values are first reduced to distinct (column, value) pairs, so that no task holds a column's
    value set.
    """
    return (
        unpivot(df, columns)
        .filter(F.col("value").isNotNull())
        .distinct()
        .groupBy("column")
        .agg(F.count(F.lit(1)).alias("n_distinct"))
    )


def unpivot(df: DataFrame, columns: Sequence[str], dtype: str = "string") -> DataFrame:
    """One row per (column, value) of the listed columns, in one scan."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast(dtype).alias("value")) for c in columns])
    return df.select(F.explode(pairs).alias("p")).select("p.column", "p.value")


def value_distribution(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Value counts of every listed column in one job."""
    return unpivot(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def modes(df: DataFrame, columns: Sequence[str], ignore: str | None = None) -> DataFrame:
    """Most frequent value per column; among equals the smallest. ``ignore`` skips a marker value."""
    counts = value_distribution(df, columns).filter(F.col("value").isNotNull())
    if ignore is not None:
        counts = counts.filter(F.col("value") != ignore)
    best = F.min(F.struct((-F.col("n")).alias("neg"), F.col("value").alias("value"))).alias("b")
    return counts.groupBy("column").agg(best).select("column", F.col("b.value").alias("mode"), (-F.col("b.neg")).alias("n"))


def summary(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """count, mean, sample stddev, min and max of numeric columns, long form and numeric."""
    stats = []
    for c in columns:
        v = F.col(f"`{c}`").cast("double")
        stats.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(v).alias("n"),
                F.round(F.avg(v), digits).alias("mean"),
                F.round(F.stddev_samp(v), digits).alias("stddev"),
                F.min(v).alias("min"),
                F.max(v).alias("max"),
            )
        )
    return df.agg(F.array(*stats).alias("s")).select(F.explode("s").alias("s")).select("s.*")


def nulls_per_column(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: null count of every column."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns or df.columns])


def matches_per_column(df: DataFrame, marker: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: how often each column equals a marker text. Columns of other types count 0."""
    text = {f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "varchar", "char")}
    return df.agg(
        *[
            (F.count_if(F.col(f"`{c}`") == marker) if c in text else F.lit(0).cast("bigint")).alias(c)
            for c in columns or df.columns
        ]
    )


def contingency(df: DataFrame, row: str, col: str, values: Sequence[object], other: str = "other") -> DataFrame:
    """Two-way count table, one output column per listed value of ``col``, absent cells 0.

    What is not listed, nulls included, is counted in column ``other``, so a row's cells add up to its rows.
    """
    cells = [F.count_if(F.col(col) == v).alias(str(v)) for v in values]
    rest = F.count_if(~F.coalesce(F.col(col).isin(*values), F.lit(False))).alias(other)
    return df.groupBy(row).agg(*cells, rest)


def contingency_long(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Counts of several two-way tables in one scan: (left, right, left_value, right_value, n)."""
    cells = F.array(
        *[
            F.struct(
                F.lit(a).alias("left"),
                F.lit(b).alias("right"),
                F.col(a).cast("string").alias("left_value"),
                F.col(b).cast("string").alias("right_value"),
            )
            for a, b in pairs
        ]
    )
    flat = df.select(F.explode(cells).alias("c")).select("c.*")
    return flat.groupBy("left", "right", "left_value", "right_value").agg(F.count(F.lit(1)).alias("n"))


def largest_cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Largest cell of the contingency table of every pair of columns."""
    cells = contingency_long(df, list(combinations(columns, 2)))
    return cells.groupBy("left", "right").agg(F.max("n").alias("largest"))


def pearson_pairs(df: DataFrame, columns: Sequence[str], full: bool = False, digits: int = 6) -> DataFrame:
    """Pearson r of column pairs in one pass: pairs i<j, or the full matrix."""
    pairs = [(a, b) for a in columns for b in columns] if full else list(combinations(columns, 2))
    rows = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.round(F.corr(F.col(a), F.col(b)), digits).alias("r"))
        for a, b in pairs
    ]
    return df.agg(F.array(*rows).alias("m")).select(F.explode("m").alias("m")).select("m.*")


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], error: float = 0.001) -> DataFrame:
    """Discrete quantiles (the smallest value with at least ``p`` of the rows at or below it).

    Two scans and no full sort. A sketch with a guaranteed rank error brackets each wanted value;
    then rows inside a bracket are counted per value and rows between brackets only per gap. What
    is left to sort is the few values inside the brackets, and the answer is exact.
    """
    # four times the sketch's rank error also covers its rounding to whole ranks on small tables
    ends = [min(max(p + d * error, 0.0), 1.0) for p in probs for d in (-4, 4)]
    sketch = dict(zip(columns, df.approxQuantile(list(columns), ends, error)))
    brackets = {c: _merged(list(zip(v[::2], v[1::2]))) for c, v in sketch.items() if v}
    if not brackets:
        return df.sparkSession.createDataFrame([], "column string, prob double, value double")
    cells = [
        F.struct(F.lit(c).alias("column"), *_bracket_cell(F.col(f"`{c}`").cast("double"), found))
        for c, found in brackets.items()
    ]
    flat = df.select(F.explode(F.array(*cells)).alias("c")).select("c.*").filter(F.col("value").isNotNull())
    counts = flat.groupBy("column", "value", "side").agg(F.count(F.lit(1)).alias("n"))
    order = [F.col("column"), F.col("value"), F.col("side")]
    run = with_running_sums(counts, order, {"upto": F.col("n")})
    bounds = run.groupBy("column").agg(F.min(F.col("upto") - F.col("n")).alias("base"), F.sum("n").alias("total"))
    # one row per column name, which is what bounds this broadcast
    placed = run.join(F.broadcast(bounds), "column")
    rank_hi = F.col("upto") - F.col("base")
    rank_lo = rank_hi - F.col("n")
    wanted = F.array(*[F.lit(float(p)) for p in probs])

    def hit(p: Column) -> Column:
        target = F.greatest(F.ceil(p * F.col("total")), F.lit(1))
        return (target > rank_lo) & (target <= rank_hi)

    exact = F.when(F.col("side") == 0, F.col("value")).otherwise(F.raise_error(F.lit("quantile outside its bracket")).cast("double"))
    return placed.select("column", F.explode(F.filter(wanted, hit)).alias("prob"), exact.alias("value"))


def _merged(brackets: Sequence[tuple[float, float]]) -> list[tuple[float, float]]:
    """Sorted brackets with overlapping ones joined."""
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(brackets):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _bracket_cell(v: Column, brackets: Sequence[tuple[float, float]]) -> list[Column]:
    """(value, side): the value itself (side 0) in a bracket, else the bracket end it lies beyond."""
    value, side = F.lit(brackets[0][0]), F.lit(-1)
    for lo, hi in brackets:
        value = F.when(v > hi, F.lit(hi)).when(v >= lo, v).otherwise(value)
        side = F.when(v > hi, F.lit(1)).when(v >= lo, F.lit(0)).otherwise(side)
    return [F.when(v.isNotNull() & ~F.isnan(v), value).alias("value"), side.alias("side")]


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], error: float = 0.0) -> dict[str, list[float]]:
    """Quantiles on the driver (``columns x probs`` numbers): exact at error 0, else by sketch."""
    if error > 0:
        return dict(zip(columns, df.approxQuantile(list(columns), list(probs), error)))
    rows = exact_quantiles(df, columns, probs).collect()  # columns x probs rows
    found = {(r["column"], r["prob"]): r["value"] for r in rows}
    return {c: [found.get((c, float(p))) for p in probs] for c in columns}


def argmax(df: DataFrame, score: str, key: str) -> DataFrame:
    """The single row (key, score) with the highest score; among equals the largest key."""
    best = F.max(F.struct(F.col(score).alias("s"), F.col(key).alias("k"))).alias("b")
    return df.agg(best).select(F.col("b.k").alias(key), F.col("b.s").alias(score))


def value_runs(df: DataFrame, key: str, value: str) -> DataFrame:
    """All values of each key as (key, value, n): equal values are counted, nothing is gathered."""
    return df.groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))


def joined_distinct(df: DataFrame, column: str, sep: str = ", ", block: int = 512) -> DataFrame:
    """Distinct values of a column as text, in order: row ``block`` n joins the values from ``block * n`` on.

    A category column fills one row; any number of values fills as many rows as it needs, so no
    row grows with the data. Nulls are left out.
    """
    values = df.select(F.col(column).cast("string").alias("v")).filter(F.col("v").isNotNull()).distinct()
    placed = with_position(values, [F.col("v")], "at").select((F.col("at") / block).cast("long").alias("block"), "v")
    return placed.groupBy("block").agg(F.array_join(F.sort_array(F.collect_list("v")), sep).alias("vals"))
