"""Item-to-item similarity from co-ratings, and nearest vectors."""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import lookup_few
from millrace.storage import broadcast_if_small, materialize


def _pair_sums(pairs: DataFrame) -> DataFrame:
    """Algebraic sums per item pair; these combine map-side, right behind the join that pairs up."""
    return pairs.groupBy("item1", "item2").agg(
        F.sum(F.col("r1") * F.col("r2")).alias("xy"),
        F.sum(F.col("r1") * F.col("r1")).alias("xx"),
        F.sum(F.col("r2") * F.col("r2")).alias("yy"),
        F.count(F.lit(1)).alias("n_pairs"),
    )


def _self_pairs(ratings: DataFrame, per_user: DataFrame, largest: int, block: int) -> DataFrame:
    """Unordered pairs of a user's items, each once.

    A user with more than ``block`` rows is cut into blocks: one side lands in its own block, the
    other is sent to every block, so no task pairs more than ``block`` rows of a user with the rest.
    """
    left = ratings.select("user_id", F.col("item_id").alias("item1"), F.col("rating").alias("r1"))
    right = ratings.select("user_id", F.col("item_id").alias("item2"), F.col("rating").alias("r2"))
    if largest <= block:
        return left.join(right, "user_id").filter(F.col("item1") < F.col("item2"))
    wide = per_user.filter(F.col("n") > block).select(
        "user_id", F.ceil(F.col("n") / block).cast("int").alias("blocks")
    )
    wide = broadcast_if_small(wide)
    blocks = F.coalesce("blocks", F.lit(1))
    left = left.join(wide, "user_id", "left").withColumn("block", F.pmod(F.hash("item1"), blocks)).drop("blocks")
    right = (
        right.join(wide, "user_id", "left")
        .withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .drop("blocks")
    )
    return left.join(right, ["user_id", "block"]).filter(F.col("item1") < F.col("item2"))


def _stripes(ratings: DataFrame, per_user: DataFrame, largest: int, block: int, stored: bool = False) -> DataFrame:
    """(item1, r1, items, rs): each rating with the user's ratings of larger items, in order.

    A user with more than ``block`` rows is cut as in ``_self_pairs``: lists of about ``block`` items, and
    each of the user's ratings goes to every list. ``stored``: the lists are, for more than one use.
    """
    pair = F.sort_array(F.collect_list(F.struct("item_id", "rating"))).alias("l")
    ratings = ratings.filter(F.col("user_id").isNotNull() & F.col("item_id").isNotNull())
    narrow = ratings
    if largest > block:
        wide = broadcast_if_small(materialize(per_user.filter(F.col("n") > block).select("user_id", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "wide_users"))
        narrow = ratings.join(wide, "user_id", "left_anti")
    lists = narrow.groupBy("user_id").agg(pair).select(F.col("l")["item_id"].alias("items"), F.col("l")["rating"].alias("rs"))
    if stored:
        lists = materialize(lists, "user_lists")
    cut = lists.select(F.posexplode("items").alias("at", "item1"), "items", "rs").filter(F.col("at") + 1 < F.size("items"))
    behind = F.col("at") + 2, F.size("items")
    out = cut.select("item1", F.element_at("rs", F.col("at") + 1).alias("r1"), F.slice("items", *behind).alias("items"), F.slice("rs", *behind).alias("rs"))
    if largest <= block:
        return out
    rows = ratings.join(wide, "user_id")
    parts = rows.groupBy("user_id", F.pmod(F.hash("item_id"), "blocks").alias("block")).agg(pair)
    left = rows.select("user_id", F.col("item_id").alias("item1"), F.col("rating").alias("r1"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    met = left.join(materialize(parts, "lists"), ["user_id", "block"])
    met = met.select("item1", "r1", F.filter("l", lambda e: e["item_id"] > F.col("item1")).alias("l")).filter(F.size("l") > 0)
    return out.unionByName(met.select("item1", "r1", F.col("l")["item_id"].alias("items"), F.col("l")["rating"].alias("rs")))


def _pairs_of(stripes: DataFrame) -> DataFrame:
    each = stripes.select("item1", "r1", F.explode(F.arrays_zip("items", "rs")).alias("e"))
    return each.select("item1", F.col("e.items").alias("item2"), "r1", F.col("e.rs").alias("r2"))


def _user_pair_sums(
    ratings: DataFrame,
    per_user: DataFrame,
    largest: int,
    block: int,
    least: int = 1,
    dense: float = 4.0,
    per_task: int = 1_000_000,
    hot_rows: int = 200_000,
    wave_pairs: int = 50_000_000,
) -> DataFrame:
    """``_pair_sums`` over all pairs of items of one user, of those that meet ``least`` times.

    Where a pair of items meets ``dense`` times or more on average, pairs are summed map-side. Where
    most pairs meet once or twice that saves nothing, and each would travel as a row of keys and sums: there a
    rating travels to its item's task with the user's larger items as a list, and pairs are only formed
    and summed behind that shuffle, about ``per_task`` of them a task. Items with more than ``hot_rows`` ratings
    are summed map-side again, so that none fills one task.

    Those lists hold every pair once, so they come in waves of items, each summed, stored and its shuffle
    dropped before the next: a wave has about four pairs for each rating (``wave_pairs``, if that is more), so the disk
    follows the ratings, and reading the users' lists again for each wave is less than what the wave writes.
    """
    n = F.col("n").cast("double")
    formed, rated = per_user.agg(F.sum(n * (n - 1) / 2), F.sum(n)).first()
    formed = formed or 0.0
    enough = F.col("n_pairs") >= least
    per_item = materialize(ratings.groupBy("item_id").agg(F.count(F.lit(1)).alias("n")), "item_sizes")
    items = per_item.count()
    if formed >= dense * items * (items - 1) / 2:
        return _pair_sums(_self_pairs(ratings, per_user, largest, block)).filter(enough)
    waves = max(1, math.ceil(formed / max(wave_pairs, 4 * (rated or 0))))
    stripes = _stripes(ratings, per_user, largest, block, stored=waves > 1)
    hot = per_item.filter(F.col("n") > hot_rows).select(F.col("item_id").alias("item1"))
    parts = max(int(ratings.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(formed / waves / per_task))
    hot = None if hot.isEmpty() else broadcast_if_small(hot)

    def sums(stripes: DataFrame) -> DataFrame:
        if hot is None:
            return _pair_sums(_pairs_of(stripes.repartition(parts, "item1"))).filter(enough)
        rare = _pair_sums(_pairs_of(stripes.join(hot, "item1", "left_anti").repartition(parts, "item1")))
        return rare.unionByName(_pair_sums(_pairs_of(stripes.join(hot, "item1", "left_semi")))).filter(enough)

    if waves == 1:
        return sums(stripes)
    # Another hash than that of the shuffle, which would leave most of its partitions empty.
    wave = F.pmod(F.xxhash64("item1"), F.lit(waves))
    return functools.reduce(DataFrame.unionByName, [materialize(sums(stripes.filter(wave == w)), "pair_sums") for w in range(waves)])


def co_rated_sums(
    ratings: DataFrame, min_pairs: int = 1, block: int = 4096, heavy_rows: int = 20_000, **shape: float
) -> DataFrame:
    """Per unordered item pair (item1 < item2): sums over the users who rated both.

    ``ratings(user_id, item_id, rating)`` has one row per (user, item). Only pairs with at least
    ``min_pairs`` common users come out, and two exact facts keep the work near that result:

    * an item with fewer than ``min_pairs`` ratings is in no such pair;
    * a pair with ``min_pairs`` common users has at least ``min_pairs - h`` among all but ``h`` users.
      So up to ``min_pairs - 1`` of the heaviest users (over ``heavy_rows`` rows) never have their
      items paired: the other users give the candidates, and the heavy users' ratings are looked
      up for those candidates only.

    ``shape``: see ``_user_pair_sums``.
    """
    return stored_co_rated_sums(materialize(ratings.select("user_id", "item_id", "rating"), "ratings"), min_pairs, block, heavy_rows, **shape)


def stored_co_rated_sums(ratings: DataFrame, min_pairs: int, block: int = 4096, heavy_rows: int = 20_000, **shape: float) -> DataFrame:
    """``co_rated_sums`` of a stored table. What is read more than once is stored, since a shuffle that is not written out stays."""
    if min_pairs > 1:
        common = ratings.groupBy("item_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_pairs)
        ratings = materialize(ratings.join(materialize(common.select("item_id"), "common_items"), "item_id", "left_semi"), "common_ratings")
    per_user = materialize(ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")), "user_sizes")
    # at most min_pairs rows come to the driver here
    top = per_user.orderBy(F.desc("n"), "user_id").limit(max(min_pairs, 1)).collect()
    heavy = [r["user_id"] for r in top[: min_pairs - 1] if r["n"] > heavy_rows]
    largest = max((r["n"] for r in top[len(heavy):]), default=0)
    if not heavy:
        return _user_pair_sums(ratings, per_user, largest, block, min_pairs, **shape)

    is_heavy = F.col("user_id").isin(heavy)
    light = ratings.filter(~is_heavy)
    candidates = _user_pair_sums(light, per_user.filter(~is_heavy), largest, block, min_pairs - len(heavy), **shape)
    candidates = materialize(candidates, "candidates")
    rated = ratings.filter(is_heavy)
    first = rated.select("user_id", F.col("item_id").alias("item1"), F.col("rating").alias("r1"))
    second = rated.select("user_id", F.col("item_id").alias("item2"), F.col("rating").alias("r2"))
    extra = _pair_sums(candidates.select("item1", "item2").join(first, "item1").join(second, ["user_id", "item2"]))
    both = candidates.unionByName(extra).groupBy("item1", "item2")
    total = both.agg(*[F.sum(c).alias(c) for c in ("xy", "xx", "yy", "n_pairs")])
    return total.filter(F.col("n_pairs") >= min_pairs)


def _cosine() -> Column:
    """Σxy / (√Σx² · √Σy²); null when a side is all zeros."""
    return F.try_divide(F.col("xy").cast("double"), F.sqrt("xx") * F.sqrt("yy"))


def item_cosine(ratings: DataFrame, min_pairs: int = 1, digits: int = 6, **limits: int) -> DataFrame:
    """Cosine of every item pair with at least ``min_pairs`` common users, and their number."""
    sums = co_rated_sums(ratings, min_pairs, **limits)
    return sums.select("item1", "item2", F.round(_cosine(), digits).alias("score"), "n_pairs")


def similar_items(
    ratings: DataFrame,
    names: DataFrame,
    item: int,
    k: int = 10,
    min_score: float = 0.97,
    min_pairs: int = 51,
    digits: int = 6,
) -> DataFrame:
    """The ``k`` items most similar to one item, named.

    Only rows of users who rated the item take part, so the cost follows those users' rows and
    not the number of item pairs.
    """
    mine = ratings.filter(F.col("item_id") == item).select("user_id", F.col("rating").alias("r1"))
    others = ratings.filter(F.col("item_id") != item).select(
        "user_id", F.col("item_id").alias("item2"), F.col("rating").alias("r2")
    )
    pairs = others.join(mine, "user_id").withColumn("item1", F.lit(item))
    scored = _pair_sums(pairs).select(
        F.col("item2").alias("item_id"), F.round(_cosine(), digits).alias("score"), "n_pairs"
    )
    best = scored.filter((F.col("score") > min_score) & (F.col("n_pairs") >= min_pairs))
    order = [F.desc("score"), F.desc("n_pairs"), F.col("item_id")]
    return lookup_few(best.orderBy(*order).limit(k), names, "item_id", "id", ["name"])


def nearest_vectors(df: DataFrame, key: str, vector: str, target: object, k: int = 10, digits: int = 6) -> DataFrame:
    """The ``k`` rows whose array column has the highest cosine with the target row's (itself first).

    The target's single vector becomes a literal, and each task keeps its own best ``k``.
    """
    row = df.filter(F.col(key) == target).select(F.col(vector).cast("array<double>").alias("v")).first()
    if row is None:
        raise ValueError(f"no row with {key} = {target!r}")
    probe = F.array(*[F.lit(x) for x in row["v"]])
    own = F.col(vector).cast("array<double>")

    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)

    probe_norm = sum(x * x for x in row["v"]) ** 0.5
    score = F.try_divide(dot(own, probe), F.sqrt(dot(own, own)) * F.lit(probe_norm))
    scored = df.select(key, F.round(score, digits).alias("score"))
    return scored.orderBy(F.col(key) != target, F.desc_nulls_last("score"), key).limit(k)
