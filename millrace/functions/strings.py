"""Text and array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokens(text: Column, pattern: str = " ", keep_empty: bool = False) -> Column:
    """Array of tokens between matches of ``pattern``; empty tokens are dropped by default."""
    parts = F.split(text, pattern)
    return parts if keep_empty else F.filter(parts, lambda t: t != "")


def words(text: Column) -> Column:
    """Tokens between runs of non-word characters (ASCII letters, digits and underscore)."""
    return tokens(text, r"\W+")


def adjacency_id(line: Column) -> Column:
    """Leading id of a blank-separated adjacency line; null when it is not a number."""
    return F.substring_index(F.ltrim(line), " ", 1).try_cast("bigint")


def adjacency_tail(line: Column) -> Column:
    """The tokens after the first one. Empty ones go: a cast that fails costs far more than one that does not."""
    return F.slice(F.array_remove(F.split(line, " "), ""), F.lit(2), F.lit(2**30))


def adjacency_neighbours(line: Column) -> Column:
    """The ids after the first one; tokens that are not numbers are left out."""
    return F.array_compact(adjacency_tail(line).try_cast("array<bigint>"))


def quoted_name(line: Column) -> Column:
    """Text between the first pair of double quotes; null when there is none."""
    return F.nullif(F.regexp_extract(line, '"([^"]*)"', 1), F.lit(""))


def leading_id(line: Column) -> Column:
    return F.regexp_extract(line, r"^\s*(\d+)\s", 1).try_cast("bigint")
