"""Numeric, conditional and time expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_or_empty_default(col: Column, dtype: str, default: float = 0) -> Column:
    """``default`` where the text is null or empty, otherwise the cast (null if not a number)."""
    return F.when(col.isNull() | (col == ""), F.lit(default).cast(dtype)).otherwise(col.try_cast(dtype))


def tenths_celsius_to_fahrenheit(tenths: Column) -> Column:
    return F.round(tenths * 0.1 * (9.0 / 5.0) + 32.0, 2)


def threshold_label(col: Column, threshold: float, high: str = "high", low: str = "low") -> Column:
    return F.when(col > threshold, high).otherwise(low)


def interval_label(
    col: Column, edges: Sequence[float], labels: Sequence[str] | None = None, default: str = "Out"
) -> Column:
    """Label of the first interval ``[edges[i], edges[i+1]]`` that holds the value.

    Both ends are inclusive, so a value on an inner edge belongs to the lower interval. Values
    outside every interval, and nulls, get ``default``.
    """
    if labels is None:
        labels = [f"{lo}-{hi}" for lo, hi in zip(edges, edges[1:])]
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per interval")
    steps = list(zip(edges, edges[1:], labels))
    first = F.when(col.between(*steps[0][:2]), steps[0][2])
    return reduce(lambda chain, s: chain.when(col.between(s[0], s[1]), s[2]), steps[1:], first).otherwise(default)


def floor_bucket(col: Column, width: int) -> Column:
    """Lower edge of the fixed-width bucket holding the value."""
    return (F.floor(col / width) * width).cast("bigint")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``100 * part / whole`` rounded; null when ``whole`` is zero."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), digits)


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970-01-01 of a timestamp without zone."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts)


def epoch_to_text(seconds: Column, pattern: str = "dd-MM-yyyy hh:mm") -> Column:
    """Epoch seconds as text; the default pattern has a 12-hour clock without marker."""
    return F.date_format(F.timestamp_add("SECOND", seconds, F.lit("1970-01-01").cast("timestamp_ntz")), pattern)


def unit_hash(*cols: Column, salt: str = "") -> Column:
    """A reproducible number in [0, 1) per key, the same on any cluster and partitioning."""
    digest = F.md5(F.concat_ws("|", F.lit(salt), *[c.cast("string") for c in cols]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))
