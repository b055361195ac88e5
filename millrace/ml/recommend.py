"""Matrix-factorisation recommendation."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.ml import block_als, product_search
from millrace.ml.block_als import Blocks, FactorModel
from millrace.operators.joins import lookup
from millrace.operators.ranking import top_per_key, with_position
from millrace.operators.similarity import item_cosine, nearest_vectors
from millrace.storage import materialize, scratch_path, ship_package

BLOCK = 4096
#: Ratings that the library's ALS holds in its ten blocks; beyond that they lie in shared files.
ALS_ROWS = 20_000_000


def als(rank: int = 10, iterations: int = 10, reg: float = 0.01, nonnegative: bool = False, seed: int = 1) -> ALS:
    """Explicit-rating ALS that drops pairs it cannot score.

    Item factors are checkpointed in every iteration, where the session has ``spark.checkpoint.dir``: ALS then drops the
    shuffles behind them, so what a fit keeps on disk does not grow with its iterations.
    """
    return ALS(
        userCol="user_id",
        itemCol="item_id",
        ratingCol="rating",
        rank=rank,
        maxIter=iterations,
        regParam=reg,
        nonnegative=nonnegative,
        coldStartStrategy="drop",
        seed=seed,
        checkpointInterval=1,
    )


class Fits:
    """Any number of ALS fits on one table of ratings (``user_id``, ``item_id`` int, ``rating``).

    Up to ``most`` ratings the library's; beyond, and if ids are numbers from 0 on, fits of the same factorisation over
    blocks in shared files (``block_als``), which are dealt once for all fits. ``release`` removes them.
    """

    def __init__(self, ratings: DataFrame, most: int = ALS_ROWS):
        n, low, high = ratings.agg(F.count(F.lit(1)), F.min(F.least("user_id", "item_id")), F.max(F.greatest("user_id", "item_id"))).first()
        self._ratings, self._blocks = ratings, Blocks(ratings) if n > most and low >= 0 and high < n else None

    def fit(self, rank: int, iterations: int, reg: float, seed: int = 1, cold: str = "drop") -> ALSModel | FactorModel:
        if self._blocks is not None:
            return self._blocks.fit(rank, iterations, reg, seed, cold)
        return als(rank=rank, iterations=iterations, reg=reg, seed=seed).setColdStartStrategy(cold).fit(self._ratings)

    def release(self) -> None:
        if self._blocks is not None:
            self._blocks.release()


def fit_als(ratings: DataFrame, rank: int, iterations: int, reg: float, seed: int = 1) -> ALSModel | FactorModel:
    """One fit that drops pairs it cannot score."""
    fits = Fits(ratings)
    try:
        return fits.fit(rank, iterations, reg, seed)
    finally:
        fits.release()


def dense_ids(df: DataFrame, column: str) -> DataFrame:
    """Dictionary (``column``, ``id`` int) of the distinct values, of any type, numbered in order; stored."""
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return materialize(with_position(values, [F.col(column)], "id").select(column, F.col("id").cast("int").alias("id")), "ids")


def with_dense_ids(ratings: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """``user_id``, ``item_id`` replaced by their numbers in two dictionaries; ``rating`` as float."""
    u, i = users.withColumnsRenamed({"user_id": "_u", "id": "_uid"}), items.withColumnsRenamed({"item_id": "_i", "id": "_iid"})
    joined = ratings.join(u, F.col("user_id") == F.col("_u")).join(i, F.col("item_id") == F.col("_i"))
    return joined.select(F.col("_uid").alias("user_id"), F.col("_iid").alias("item_id"), F.col("rating").cast("float").alias("rating"))


def neighbour_candidates(ratings: DataFrame, per_item: int = 20, min_pairs: int = 2) -> DataFrame:
    """(user_id, item_id) worth scoring: unrated items among the ``per_item`` most similar to one the user rated."""
    ratings = materialize(ratings.select("user_id", "item_id", "rating"), "ratings")
    pairs = item_cosine(ratings, min_pairs)
    ends = F.explode(F.array(F.struct(F.col("item1").alias("own"), F.col("item2").alias("other")), F.struct(F.col("item2").alias("own"), F.col("item1").alias("other"))))
    near = top_per_key(pairs.select("score", ends.alias("e")).select("score", "e.own", "e.other"), ["own"], [F.desc_nulls_last("score"), F.col("other")], per_item)
    stored = materialize(near.select("own", "other"), "neighbours")
    met = ratings.join(stored, F.col("item_id") == F.col("own")).select("user_id", F.col("other").alias("item_id"))
    met = materialize(met.distinct(), "met")
    return met.join(ratings.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")


def score_pairs(model: ALSModel | FactorModel, pairs: DataFrame) -> DataFrame:
    """Predicted rating of given (user_id, item_id) pairs: two key joins with the factor tables."""
    users = model.userFactors.select(F.col("id").alias("_u"), F.col("features").alias("_uf"))
    items = model.itemFactors.select(F.col("id").alias("_i"), F.col("features").alias("_if"))
    joined = pairs.join(users, F.col("user_id") == F.col("_u")).join(items, F.col("item_id") == F.col("_i"))
    dot = F.aggregate(F.zip_with("_uf", "_if", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, v: s + v)
    return joined.select("user_id", "item_id", dot.alias("score"))


def recommend_items(model: ALSModel, pairs: DataFrame, k: int, names: DataFrame | None = None) -> DataFrame:
    """Top ``k`` of each user's candidate items in ``pairs(user_id, item_id)``, one row per item, named.

    For some users only, pass the pairs of those users.
    """
    best = top_per_key(score_pairs(model, pairs), ["user_id"], [F.desc("score"), F.col("item_id")], k)
    return best if names is None else lookup(best, names, "item_id", "id", ["name"])


def recommend_users(model: ALSModel, pairs: DataFrame, k: int) -> DataFrame:
    """Top ``k`` candidate users of each item in ``pairs(user_id, item_id)``."""
    return top_per_key(score_pairs(model, pairs), ["item_id"], [F.desc("score"), F.col("user_id")], k)


def _by_blocks(rows: DataFrame, order: list[Column], block: int) -> DataFrame:
    """``rows(id, features, norm, floor)`` in blocks of ``block`` neighbours under ``order``, a row per block."""
    placed = with_position(rows, order, "_at").withColumn("_block", F.floor(F.col("_at") / block))
    least = F.min(F.when(F.col("floor") > 0, F.col("floor") / F.col("norm")).otherwise(0.0))
    packed = placed.groupBy("_block").agg(F.max("norm").alias("_reach"), least.alias("_need"), F.collect_list(F.struct("id", "features", "floor")).alias("_rows"))
    held = F.col("_rows")
    return packed.select("_block", "_reach", "_need", held["id"].alias("_ids"), F.flatten(held["features"]).alias("_vectors"), held["floor"].alias("_floors"))


def _search(k: int) -> Callable:
    """Best ``k`` rows of the data blocks that meet a query block, for each of its rows, none below that row's floor."""

    # A closure, so that workers get it by value and need no package.
    def search(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def out(ids, held, scores):
            row, place = np.nonzero(held >= 0)
            return pa.RecordBatch.from_arrays([pa.array(ids[row], pa.int32()), pa.array(held[row, place], pa.int32()), pa.array(scores[row, place], pa.float64())], names=["id", "other", "score"])

        group = None
        for batch in batches:
            for i in range(batch.num_rows):
                if batch.column("_group")[i].as_py() != group:
                    if group is not None:
                        yield out(ids, held, best)
                    group = batch.column("_group")[i].as_py()
                    ids, vectors, floors = (batch.column(c)[i].values.to_numpy() for c in ("_ids", "_vectors", "_floors"))
                    own, floors = vectors.reshape(len(ids), -1), floors.copy()
                    norms = np.sqrt((own * own).sum(axis=1))
                    held, best = np.full((len(ids), k), -1, np.int64), np.full((len(ids), k), -np.inf)
                others, theirs = (batch.column(c)[i].values.to_numpy() for c in ("_others", "_theirs"))
                theirs = theirs.reshape(len(others), -1)
                # Far above what the order of additions can change in a product.
                margin = 1e-9 * norms * np.sqrt((theirs * theirs).sum(axis=1).max())
                for at in range(0, len(ids), 256):
                    part, least = own[at : at + 256], floors[at : at + 256]
                    rough, cut = part @ theirs.T, least
                    if len(others) > k and np.isneginf(least).any():
                        cut = np.maximum(least, np.partition(rough, -k, axis=1)[:, -k] - margin[at : at + 256])
                    row, col = np.nonzero(rough >= (cut - margin[at : at + 256])[:, None])
                    # Added up one factor after another, so that a score does not depend on the blocks.
                    score = np.zeros(len(row))
                    for f in range(part.shape[1]):
                        score += part[row, f] * theirs[col, f]
                    known = score >= least[row]
                    row, other, score = row[known], others[col[known]], score[known]
                    if not len(row):
                        continue
                    old, place = np.nonzero(held[at : at + 256] >= 0)
                    row, other, score = np.concatenate([old, row]), np.concatenate([held[at + old, place], other]), np.concatenate([best[at + old, place], score])
                    order = np.lexsort((other, -score, row))
                    row, other, score = row[order], other[order], score[order]
                    place = np.arange(len(row)) - np.searchsorted(row, row)
                    row, other, score, place = (v[place < k] for v in (row, other, score, place))
                    held[at + row, place], best[at + row, place] = other, score
                    last = place == k - 1
                    floors[at + row[last]] = np.maximum(floors[at + row[last]], score[last])
        if group is not None:
            yield out(ids, held, best)

    return search


def best_products(queries: DataFrame, data: DataFrame, k: int, block: int = BLOCK) -> DataFrame:
    """(id, other, rank, score): for each vector of ``queries(id, features)`` the ``k`` of all of ``data`` with the largest inner product.

    Exact; among equals the smaller id first. Data vectors stand in blocks by falling norm, a shared file each. The first block
    gives every query a floor, its ``k``-th score there; a later block is only searched for queries with
    |query| * (largest norm in the block) not below their floor. Queries are put into blocks by that need, and
    a block of them reads the files it needs one after another. Vectors of nearly equal norm leave little to skip.
    """
    spark = queries.sparkSession
    ship_package(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    doubles = F.col("features").cast("array<double>")
    norm = F.sqrt(F.aggregate("features", F.lit(0.0), lambda s, v: s + v * v))
    nothing = F.lit(float("-inf"))

    def prepared(df: DataFrame) -> DataFrame:
        return df.select("id", doubles.alias("features")).withColumn("norm", norm).withColumn("floor", nothing)

    wanted = materialize(prepared(queries), "query_vectors")
    blocks = materialize(_by_blocks(prepared(data), [F.desc("norm"), F.col("id")], block), "data_blocks")
    theirs = blocks.select(F.col("_block").alias("_other"), F.col("_ids").alias("_others"), F.col("_vectors").alias("_theirs"))
    columns, out = ["_group", "_ids", "_vectors", "_floors", "_others", "_theirs"], "id int, other int, score double"

    start = _by_blocks(wanted, [F.col("id")], block).repartition(parts, "_block").crossJoin(F.broadcast(theirs.filter("_other = 0")))
    found = materialize(start.withColumn("_group", F.col("_block")).select(*columns).mapInArrow(_search(k), out), "first_block")

    floors = found.groupBy("id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(nothing).alias("_floor"))
    floored = wanted.join(floors, "id").select("id", "features", "norm", F.col("_floor").alias("floor"))
    need = F.when(F.col("floor") > 0, F.col("floor") / F.col("norm")).otherwise(0.0)
    asked = materialize(_by_blocks(floored, [need, F.col("id")], block), "query_blocks")
    # One number per block; those of the data fall from block to block.
    folder = scratch_path(spark, "vector_files")
    held = theirs.filter("_other > 0").mapInArrow(product_search.writer(folder), "block bigint")
    materialize(held, "vector_files_written")
    reach = [r["_reach"] for r in blocks.filter("_block > 0").select("_block", "_reach").orderBy("_block").collect()]
    # The data blocks of a query block come one after another, and each raises its floors for the next; few query blocks are dealt out in shares.
    shares = max(1, math.ceil(2 * spark.sparkContext.defaultParallelism / max(1, asked.count())))
    groups = asked.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))).repartition(parts, "_block", "_share")
    rest = materialize(groups.select("_share", "_ids", "_vectors", "_floors").mapInArrow(product_search.searcher(folder, reach, shares, k), out), "later_blocks")
    block_als.drop_folder(folder)
    return top_per_key(found.unionByName(rest), ["id"], [F.desc("score"), F.col("other")], k)


def _of(factors: DataFrame, only: DataFrame | None) -> DataFrame:
    return factors if only is None else factors.join(only.select("id"), "id", "left_semi")


def top_items(model: ALSModel | FactorModel, k: int, only: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """Top ``k`` of all items for every user, or for those in ``only(id)``: (user_id, item_id, rank, score)."""
    best = best_products(_of(model.userFactors, only), model.itemFactors, k, block)
    return best.select(F.col("id").alias("user_id"), F.col("other").alias("item_id"), "rank", "score")


def top_users(model: ALSModel | FactorModel, k: int, only: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """Top ``k`` of all users for every item, or for those in ``only(id)``: (item_id, user_id, rank, score)."""
    best = best_products(_of(model.itemFactors, only), model.userFactors, k, block)
    return best.select(F.col("id").alias("item_id"), F.col("other").alias("user_id"), "rank", "score")


def similar_factors(model: ALSModel | FactorModel, item: int, k: int = 10) -> DataFrame:
    """Items whose latent factors have the highest cosine with one item's (itself first)."""
    return nearest_vectors(model.itemFactors, "id", "features", item, k)


def item_mean_predictions(ratings: DataFrame) -> DataFrame:
    """A deterministic baseline: each (user, item) is predicted the item's mean rating."""
    # Stored, so that both sides meet through a plain exchange and Spark can split a hot item.
    means = materialize(ratings.groupBy("item_id").agg(F.avg("rating").alias("prediction")), "means")
    return ratings.join(means, "item_id").select("user_id", "item_id", "rating", "prediction")
