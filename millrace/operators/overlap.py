"""Item pairs with many common users, found by prefix filtering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.ranking import top_per_key
from millrace.operators.similarity import _cosine, _pair_sums, _user_pair_sums, stored_co_rated_sums
from millrace.storage import materialize


def split_prefixes(ratings: DataFrame, min_pairs: int) -> tuple[DataFrame, DataFrame]:
    """(prefix, rest) of ``ratings(user_id, item_id, rating)``, one row per (user, item), both stored.

    ``rest`` holds each item's ``min_pairs - 1`` raters with the most ratings, ``prefix`` all other rows.
    With users in one common order, rare ones first, two items that share ``min_pairs`` users share at
    least one in their prefixes: at most ``min_pairs - 1`` of the shared ones can stand behind them.
    Items with fewer than ``min_pairs`` raters are in neither, nor are rows with a null.
    """
    rows = ratings.select("user_id", "item_id", "rating").dropna()
    if min_pairs > 1:
        per_item = rows.groupBy("item_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_pairs)
        rows = materialize(rows, "ratings")
        rows = rows.join(materialize(per_item.select("item_id"), "common_items"), "item_id", "left_semi")
    rows = materialize(rows, "common_ratings")
    if min_pairs <= 1:
        return rows, rows.limit(0)
    per_user = materialize(rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")), "user_sizes")
    widest = top_per_key(rows.join(per_user, "user_id"), ["item_id"], [F.desc("n"), F.desc("user_id")], min_pairs - 1)
    rest = materialize(widest.select("user_id", "item_id", "rating"), "rest")
    prefix = rows.join(rest.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
    return materialize(prefix.select("user_id", "item_id", "rating"), "prefix"), rest


def overlap_sums(ratings: DataFrame, min_pairs: int, block: int = 4096, wide: int = 20_000) -> DataFrame:
    """Sums over the common users of every item pair (item1 < item2) that has at least ``min_pairs`` of them.

    While no user has more than ``wide`` ratings, all pairs of a user's items are summed where they meet,
    and none is stored. Else only pairs that meet in their prefixes are formed; of the rest only rows of such
    users stay outside, since a lookup for every candidate costs more than a narrow user's pairs. A common
    user is in both prefixes, or in the rest of the first item, or in the prefix of the first and the rest of
    the second; the last two are looked up, at most ``2 * (min_pairs - 1)`` rows a candidate. So a hot user
    costs rows, not pairs.
    """
    rows = materialize(ratings.select("user_id", "item_id", "rating").dropna(), "known_ratings")
    widest = rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if widest <= wide:
        return stored_co_rated_sums(rows, min_pairs, block)
    prefix, rest = split_prefixes(rows, min_pairs)
    if min_pairs > 1:
        # Any row of the rest may stand in the prefix as well.
        sizes = rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
        hot = materialize(sizes.filter(F.col("n") > wide).select("user_id"), "hot_users")
        prefix = prefix.unionByName(rest.join(hot, "user_id", "left_anti"))
        rest = materialize(rest.join(hot, "user_id", "left_semi").select("user_id", "item_id", "rating"), "hot_rest")
    per_user = prefix.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    largest = per_user.agg(F.max("n")).first()[0] or 0
    if min_pairs <= 1:
        return _user_pair_sums(prefix, per_user, largest, block)
    # Common users outside are hot ones.
    met = materialize(_user_pair_sums(prefix, per_user, largest, block, min_pairs - min(hot.count(), min_pairs - 1)), "candidates")

    def side(df: DataFrame, item: str, rating: str) -> DataFrame:
        return df.select("user_id", F.col("item_id").alias(item), F.col("rating").alias(rating))

    pairs = met.select("item1", "item2")
    all_rows = prefix.unionByName(rest)
    first = pairs.join(side(rest, "item1", "r1"), "item1").join(side(all_rows, "item2", "r2"), ["user_id", "item2"])
    second = pairs.join(side(rest, "item2", "r2"), "item2").join(side(prefix, "item1", "r1"), ["user_id", "item1"])
    parts = met.unionByName(_pair_sums(first.select("item1", "item2", "r1", "r2").unionByName(second.select("item1", "item2", "r1", "r2"))))
    total = parts.groupBy("item1", "item2").agg(*[F.sum(c).alias(c) for c in ("xy", "xx", "yy", "n_pairs")])
    return total.filter(F.col("n_pairs") >= min_pairs)


def similar_pairs(ratings: DataFrame, min_score: float = 0.97, min_pairs: int = 51, digits: int = 6, block: int = 4096) -> DataFrame:
    """Every item pair above both thresholds: cosine over ``min_score``, ``min_pairs`` or more common users."""
    scored = overlap_sums(ratings, min_pairs, block).select("item1", "item2", F.round(_cosine(), digits).alias("score"), "n_pairs")
    return scored.filter(F.col("score") > min_score)
